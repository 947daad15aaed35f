"""DataFrame operators: joins, rollups, calendars, sessions, normalisation, quality."""
