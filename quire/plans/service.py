"""A visual parsing service behind the converter interface: prompt, retries and quota pauses.

``call(prompt, page)`` does the request and returns {"text", "finish_reason", "usage"}; it raises
``ServiceError`` with the service's answer.  Clock and sleep are given, so that the policy can be
tested without waiting.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from quire.operators import quota
from quire.plans.converters import ConversionError, PageInput, PageResult

PROMPT = (
    "Transcribe the page as Markdown. Keep headings, lists, tables and code; describe figures in one line in square brackets; "
    "add nothing that isn't on the page. The native text below may help with spelling."
)
TAG = "native_reference"


class ServiceError(Exception):
    def __init__(self, status: int | None, snapshot: str = "", name: str = "") -> None:
        super().__init__(f"{status} {name}".strip())
        self.status, self.snapshot, self.name = status, snapshot, name

    @property
    def retryable(self) -> bool:
        return self.status in quota.RETRYABLE or (self.status or 0) >= 500 or self.name in quota.TRANSPORT


def prompt_for(page: PageInput) -> str:
    """The instruction and the native text in a tag that the text itself can't close."""
    text = re.sub(rf"(?i)</?{TAG}>", "", page.native_text)
    return f"{PROMPT}\n\n<{TAG}>\n{text}\n</{TAG}>"


@dataclass
class ServiceConverter:
    call: Callable[[str, PageInput], dict]
    limiter: quota.Limiter
    now: Callable[[], float]
    sleep: Callable[[float], None]
    model: str = "service"
    max_retries: int = 5
    pause_429: float = 60.0
    refused: int = field(default=0, init=False)

    def _send(self, page: PageInput) -> dict:
        attempt = 0
        while True:
            while not self.limiter.take(self.now()):
                self.sleep(self.limiter.wait(self.now()))
            try:
                answer = self.call(prompt_for(page), page)
                self.refused = 0
                return answer
            except ServiceError as x:
                if x.status == 429:  # waiting for quota is no failure of the page
                    self.refused += 1
                    self.sleep(quota.pause_after_429(x.snapshot, self.refused, self.pause_429, self.limiter.until_reset(self.now())))
                    continue
                attempt += 1
                if not x.retryable or attempt > self.max_retries:
                    raise ConversionError("SERVICE_ERROR", str(x)) from x
                self.sleep(quota.backoff(attempt))

    def convert_page(self, page: PageInput) -> PageResult:
        answer = self._send(page)
        reason = str(answer.get("finish_reason") or "").rsplit(".", 1)[-1].upper()
        if reason != "STOP":
            raise ConversionError(reason or "NO_FINISH_REASON")
        text = (answer.get("text") or "").strip()
        fenced = re.fullmatch(r"(?is)```(?:markdown|md)?\s*\n?(.*?)\n?```", text)
        text = fenced[1].strip() if fenced else text
        if not text:
            raise ConversionError("EMPTY_RESPONSE")
        return PageResult(text, "service", self.model, answer.get("usage") or {})

    def close(self) -> None:
        pass
