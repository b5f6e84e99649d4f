"""devpulse plans."""
