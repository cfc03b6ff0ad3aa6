"""Requests to a remote service: at most so many at once, retried with growing waits. The transport is given."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlencode

from loomspar import errors

Transport = Callable[[str, str, dict, str | None], tuple[int, str]]
#: Fixed values.
RETRIED, WAITS, PARALLEL = frozenset({429, 503}), (1, 2, 4), 10
CODES = {401: errors.AUTHENTICATION, 403: errors.AUTHENTICATION, 404: errors.NOT_FOUND, 400: errors.VALIDATION, 429: errors.RATE_LIMIT}


class Client:
    def __init__(self, base: str, transport: Transport, headers: Callable[[], dict], refresh: Callable[[], bool] = lambda: False, sleep: Callable[[float], None] = time.sleep) -> None:
        self._base, self._transport, self._headers, self._refresh, self._sleep = base.rstrip("/"), transport, headers, refresh, sleep
        self._gate = threading.Semaphore(PARALLEL)
        self._asking = threading.Lock()
        self._deployment: tuple[str, int] | None = None

    def request(self, method: str, path: str, params: dict | None = None, body: object = None) -> object:
        """The answer's JSON. Null parameters are dropped; a refused login is tried once more after a refresh."""
        query = urlencode({k: v for k, v in (params or {}).items() if v is not None})
        url, text = f"{self._base}{path}" + (f"?{query}" if query else ""), None if body is None else json.dumps(body)
        refreshed = False
        with self._gate:
            for wait in (*WAITS[:-1], None):
                try:
                    status, answer = self._transport(method, url, self._headers(), text)
                    if status == 401 and not refreshed and self._refresh():
                        refreshed = True
                        status, answer = self._transport(method, url, self._headers(), text)
                except OSError as e:
                    if wait is None:
                        raise errors.EngineError(errors.NETWORK, str(e)) from e
                    self._sleep(wait)
                    continue
                if status in RETRIED and wait is not None:
                    self._sleep(wait)
                    continue
                if status >= 400:
                    raise _failure(status, answer)
                return json.loads(answer) if answer else None
        raise AssertionError

    def pages(self, path: str, size: int = 1000, items: str = "values", **params: object) -> Iterator[object]:
        """All items of a paged list: until its total, or a short page."""
        at = 0
        while True:
            page = self.request("GET", path, {**params, "startAt": at, "maxResults": size})
            found = page if isinstance(page, list) else page.get(items, [])
            yield from found
            at += len(found)
            if not found or (at >= page["total"] if isinstance(page, dict) and "total" in page else len(found) < size):
                return


    def check_connection(self) -> dict:
        """What the server says of itself; any failure is a connection error."""
        try:
            return dict(self.request("GET", "/rest/api/2/serverInfo"))  # type: ignore[call-overload]
        except (errors.EngineError, TypeError, ValueError) as e:
            raise errors.EngineError(errors.NETWORK, f"no connection: {e}") from e

    def deployment(self) -> tuple[str, int]:
        """("cloud", 3) or ("server", 2), the version being that of its endpoints. Asked once; callers meanwhile wait."""
        with self._asking:
            if self._deployment is None:
                kind = str(self.check_connection().get("deploymentType", "Server")).lower()
                self._deployment = ("cloud", 3) if kind == "cloud" else ("server", 2)
            return self._deployment


def _failure(status: int, answer: str) -> errors.EngineError:
    try:
        body = json.loads(answer)
    except ValueError:
        body = {}
    said = [f"{k}: {v}" for k, v in (body.get("errors") or {}).items()] + list(body.get("errorMessages") or [])
    return errors.EngineError(CODES.get(status, errors.SERVER), "; ".join(said) or f"status {status}", {"status": status})
