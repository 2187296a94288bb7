"""DataFrame operators over traces, picks, frames and point sets."""
