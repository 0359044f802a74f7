"""Operators: functions ``DataFrame -> DataFrame``."""
