from ebbline.functions.columns import (
    agent_text,
    browser_family,
    day_name,
    device_family,
    event_date,
    event_hour,
    event_time,
    flag_in,
    level_flag,
    safe_ratio,
    soft_clip,
    state_of,
    whole_days_between,
)

__all__ = [
    "agent_text",
    "browser_family",
    "day_name",
    "device_family",
    "event_date",
    "event_hour",
    "event_time",
    "flag_in",
    "level_flag",
    "safe_ratio",
    "soft_clip",
    "state_of",
    "whole_days_between",
]
