"""The errors callers need to handle."""


class ValidationError(ValueError):
    """An input frame or parameter does not meet an operator's contract."""


class ConcurrentLoadError(RuntimeError):
    """Another writer has changed a stored table since this load read it; nothing of this load counts."""
