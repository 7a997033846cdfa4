"""File-stream form of the daily snapshot feed."""
