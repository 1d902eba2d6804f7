"""DataFrame operators shared by the mart jobs."""
