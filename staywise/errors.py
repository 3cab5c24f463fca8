"""Errors meant for the person who supplied the data."""


class InputError(ValueError):
    """The supplied data cannot be used; the message says why."""
