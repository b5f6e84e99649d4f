"""devpulse operators."""
