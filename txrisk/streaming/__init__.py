"""Structured Streaming: rolling destination velocity and scoring."""

from txrisk.streaming.velocity import (  # noqa: F401
    EVENT_TIME, read_event_stream, run_scoring_stream, run_velocity_stream, score_stream,
    step_of_hour, unscored_rows,
    velocity_windows,
)
