"""What several test modules share."""

from datetime import datetime


def ts(text):
    """A zone-less timestamp from 'YYYY-MM-DD[ HH:MM[:SS]]'."""
    return None if text is None else datetime.fromisoformat(text)
