"""Checks on the supplied tables: adapters, registered queries and their SQL counterparts."""
