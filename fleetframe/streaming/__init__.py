"""The schedule as Structured Streaming: late, overlapping and anti-chronological loads."""
