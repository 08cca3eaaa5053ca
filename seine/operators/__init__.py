"""Operators over captures, links and fetch logs."""
