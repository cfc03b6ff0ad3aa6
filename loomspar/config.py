"""Settings from an environment, checked."""

from __future__ import annotations

import base64
from collections.abc import Mapping
from dataclasses import dataclass
from urllib.parse import urlsplit

from loomspar.errors import CONFIGURATION, EngineError

POLICIES = ("first", "error", "score")


@dataclass(frozen=True)
class Settings:
    base_url: str
    auth: tuple[tuple[str, str], ...]
    cache_host: str = "localhost"
    cache_port: int = 6379
    ambiguity: str = "first"

    def headers(self) -> dict[str, str]:
        """Of token or basic authentication."""
        auth = dict(self.auth)
        if auth.get("type") == "basic":
            return {"Authorization": "Basic " + base64.b64encode(f"{auth['user']}:{auth['token']}".encode()).decode()}
        return {"Authorization": f"Bearer {auth['token']}"}


def _port(text: str) -> int:
    port = int(text) if text.isdigit() else 0
    if not 1 <= port <= 65535:
        raise EngineError(CONFIGURATION, f"{text} is no port")
    return port


def load(env: Mapping[str, str]) -> Settings:
    """From TRACKER_URL, TRACKER_TOKEN (with TRACKER_USER for basic), CACHE_URL or CACHE_HOST and CACHE_PORT, and
    AMBIGUITY. Explicit host and port win over the URL; a bad URL is ignored."""
    url = env.get("TRACKER_URL", "")
    if urlsplit(url).scheme not in ("http", "https") or not urlsplit(url).netloc:
        raise EngineError(CONFIGURATION, "TRACKER_URL is no http address")
    if not env.get("TRACKER_TOKEN"):
        raise EngineError(CONFIGURATION, "TRACKER_TOKEN is missing")
    policy = env.get("AMBIGUITY", "first")
    if policy not in POLICIES:
        raise EngineError(CONFIGURATION, f"{policy} is no policy")
    auth = {"type": "basic", "user": env["TRACKER_USER"], "token": env["TRACKER_TOKEN"]} if env.get("TRACKER_USER") else {"type": "token", "token": env["TRACKER_TOKEN"]}
    host, port = "localhost", 6379
    try:
        parts = urlsplit(env.get("CACHE_URL", ""))
        host, port = parts.hostname or host, parts.port or port
    except ValueError:
        pass
    return Settings(url.rstrip("/"), tuple(auth.items()), env.get("CACHE_HOST", host), _port(env["CACHE_PORT"]) if "CACHE_PORT" in env else port, policy)


def migrate(config: dict) -> dict:
    """Old settings carried a bare token; new ones carry auth."""
    auth = config.get("auth")
    if isinstance(auth, dict) and "token" in auth and "type" not in auth:
        return config | {"auth": {"type": "token", **auth}}
    return config
