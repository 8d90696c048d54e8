"""Payload sources: fetching on executors, the landing area, transports."""
