"""Fetching pages in parallel: each task is one session with its own cookies, each URL is requested once, and the results are written before anyone parses them."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.request import HTTPCookieProcessor, ProxyHandler, Request, build_opener

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FETCHED = "requested_url string, url string, status_code int, html string, success boolean, error_message string, attempts int"


@dataclass
class Response:
    url: str
    status: int
    text: str


class HttpSession:
    """A session over the standard library. ``get`` raises on network errors only; ``reset`` drops the cookies."""

    def __init__(self, headers: dict | None = None, timeout: float = 45, proxy: str | None = None):
        self.headers, self.timeout, self.proxy = headers or {}, timeout, proxy
        self.reset()

    def reset(self) -> None:
        handlers = [HTTPCookieProcessor()] + ([ProxyHandler({"http": self.proxy, "https": self.proxy})] if self.proxy else [])
        self.opener = build_opener(*handlers)

    def get(self, url: str) -> Response:
        from urllib.error import HTTPError

        try:
            with self.opener.open(Request(url, headers=self.headers), timeout=self.timeout) as r:
                return Response(r.geturl(), r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace"))
        except HTTPError as e:
            return Response(url, e.code, "")


@dataclass(frozen=True)
class Policy:
    """How to retry. ``healthy`` looks at (html, url) of a 200 and gives what is wrong with it, or None."""

    attempts: int = 3
    pause: float = 2.0
    jitter: tuple[float, float] = (0.05, 0.25)
    fresh_session: bool = True
    healthy: Callable[[str, str], str | None] | None = None
    sleep: Callable[[float], None] = time.sleep


def proxy_url(proxy: str | None, user: str | None = None, password: str | None = None) -> str | None:
    """The proxy with its credentials, unless it has some."""
    if not proxy or not user or "@" in proxy:
        return proxy or None
    scheme, _, rest = proxy.partition("://")
    return f"{scheme}://{user}:{password or ''}@{rest}"


def fetch_one(session, url: str, policy: Policy) -> tuple:
    """A row of FETCHED. Errors of the server, rate limits, lost connections and unhealthy pages are tried again, other refusals aren't."""
    error = None
    for attempt in range(1, policy.attempts + 1):
        if attempt > 1:
            if policy.fresh_session:
                session.reset()
            policy.sleep(policy.pause * attempt)
        policy.sleep(random.uniform(*policy.jitter))
        try:
            r = session.get(url)
        except Exception as e:  # noqa: BLE001 - whatever a transport raises is a failed attempt
            error = f"{type(e).__name__}: {e}"
            continue
        if not 200 <= r.status < 300:
            error = f"HTTP {r.status}"
            if r.status < 500 and r.status != 429:
                return (url, url, r.status, "", False, error, attempt)
            continue
        error = policy.healthy(r.text, r.url) if policy.healthy else None
        if error is None:
            return (url, r.url, r.status, r.text, True, None, attempt)
    return (url, url, None, "", False, error or "unknown error", policy.attempts)


def fetch(urls: DataFrame, session: Callable[[], object], workers: int = 8, policy: Policy | None = None, url: str = "url") -> DataFrame:
    """FETCHED for each different URL, by ``workers`` sessions. Write the result before parsing: reading it twice would fetch twice."""
    policy = policy or Policy()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = session()
        for batch in batches:
            yield pd.DataFrame([fetch_one(own, u, policy) for u in batch["u"]], columns=[c.split()[0] for c in FETCHED.split(", ")])

    return urls.select(F.col(url).alias("u")).where("u is not null").distinct().repartition(workers).mapInPandas(work, FETCHED)


def fetch_stats(fetched: DataFrame, lookups: int | None = None) -> DataFrame:
    """One row: requests, retries, failures (given up after all attempts; a refusal is an answer) and, if the number of pages asked for is given, cache_hits."""
    hits = [] if lookups is None else [(F.lit(lookups).cast("long") - F.count(F.lit(1))).alias("cache_hits")]
    return fetched.agg(F.sum("attempts").alias("requests"), F.sum(F.col("attempts") - 1).alias("retries"), F.count_if(~F.col("success") & F.col("status_code").isNull()).alias("failures"), *hits)
