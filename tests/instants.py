"""Instants written as text."""

import datetime as dt


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)
