"""Helpers that several test modules import."""

from datetime import datetime


def moment(text: str) -> datetime:
    return datetime.fromisoformat(text)


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()
