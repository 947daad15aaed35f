"""Readers: activity records, track points, index CSV, XML lap files, decoded messages, weight."""
