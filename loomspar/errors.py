"""Error codes, as data: findings carry a code, a message and details; only facades raise."""

from __future__ import annotations

# Fixed values.
VALIDATION, AMBIGUITY, NOT_FOUND, CONFIGURATION = "VALIDATION_ERROR", "AMBIGUITY_ERROR", "NOT_FOUND_ERROR", "CONFIGURATION_ERROR"
AUTHENTICATION, NETWORK, RATE_LIMIT, SERVER = "AUTHENTICATION_ERROR", "NETWORK_ERROR", "RATE_LIMIT_ERROR", "SERVER_ERROR"
CACHE, HIERARCHY, INPUT_PARSE, FILE_NOT_FOUND = "CACHE_ERROR", "HIERARCHY_ERROR", "INPUT_PARSE_ERROR", "FILE_NOT_FOUND_ERROR"


class EngineError(Exception):
    """What a facade raises: a code, a message, and details for programs."""

    def __init__(self, code: str, message: str, details: dict | None = None) -> None:
        super().__init__(message)
        self.code, self.message, self.details = code, message, details or {}
