"""Assembled plans: the job fact, its key checks and its sink."""
