"""Composed jobs (M1-M19), one module per family."""

from tidewater.plans import delivery, documents, engines, messages, passengers, weather

__all__ = ["delivery", "documents", "engines", "messages", "passengers", "weather"]
