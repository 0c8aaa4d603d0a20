"""Reusable DataFrame operators; none of them knows the domain."""
