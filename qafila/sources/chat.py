"""Text generation over HTTP: one POST a request, failures told apart for the pool."""

from __future__ import annotations

import json
import socket
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass
from email.utils import parsedate_to_datetime

from qafila.operators.generation import Outage
from qafila.operators.pool import RequestFailed
from qafila.operators import replay


def wait_asked(header: str | None, now: float) -> float | None:
    """Retry-After: seconds or an HTTP date; never below 0, None if neither."""
    if header is None:
        return None
    try:
        return max(0.0, float(header))
    except ValueError:
        pass
    try:
        return max(0.0, parsedate_to_datetime(header).timestamp() - now)
    except (TypeError, ValueError):
        return None


@dataclass
class HttpBackend:
    """An endpoint that speaks the common chat-completions shape. The last answer's counts are kept for telemetry."""

    url: str
    model: str
    key: str | None = None
    max_tokens: int = 1024
    temperature: float = 0.0
    timeout: float = 120.0
    told: Callable[[dict], None] | None = None  # gets every request with its answer or failure

    def chat(self, messages: list[dict], seed: int) -> str:
        body = {"model": self.model, "messages": messages, "seed": seed % (1 << 31), "max_tokens": self.max_tokens, "temperature": self.temperature}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        request = urllib.request.Request(self.url, json.dumps(body).encode(), headers)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as response:
                answer = json.loads(response.read())
            text = answer["choices"][0]["message"]["content"]
            if not isinstance(text, str):
                raise TypeError("no text")
        except urllib.error.HTTPError as e:
            raise self._failed(body, RequestFailed("http", e.code, wait_asked(e.headers.get("Retry-After"), time.time()))) from e
        except (TimeoutError, socket.timeout) as e:
            raise self._failed(body, RequestFailed("timeout")) from e
        except urllib.error.URLError as e:
            raise self._failed(body, RequestFailed("timeout" if isinstance(e.reason, TimeoutError) else "transport")) from e
        except (ValueError, KeyError, IndexError, TypeError) as e:
            raise self._failed(body, RequestFailed("malformed")) from e
        except OSError as e:
            raise self._failed(body, RequestFailed("transport")) from e
        if self.told:
            self.told({"request": body, "response": answer})
        return text

    def _failed(self, body: dict, failure: RequestFailed) -> RequestFailed:
        if self.told:
            self.told({"request": body, "failure": str(failure)})
        return failure


@dataclass
class Retrying:
    """One endpoint, asked again after passing failures with growing waits; others are raised at once."""

    backend: object
    retries: int = 3
    sleep: Callable[[float], None] = time.sleep

    def chat(self, messages: list[dict], seed: int) -> str:
        for k in range(self.retries + 1):
            try:
                return self.backend.chat(messages, seed)
            except RequestFailed as e:
                if e.event in (replay.FATAL, replay.REFUSED):
                    raise
                if k < self.retries:
                    self.sleep(min(2**k, 16) if e.retry_after is None else e.retry_after)
        raise Outage("all attempts failed")
