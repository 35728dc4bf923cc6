"""DataFrame operators (each returns a lazy DataFrame; gates run scalar actions)."""
