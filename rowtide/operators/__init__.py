"""DataFrame operators over envelopes and records."""
