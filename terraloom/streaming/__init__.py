"""Resumable passes over arriving documents."""
