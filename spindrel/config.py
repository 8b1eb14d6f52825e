"""Settings of a run, from the environment or by hand."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from spindrel.functions import fixed_values as V
from spindrel.sources.fetch import HttpSession, Policy, proxy_url

#: Headers that the pages are asked with.
HEADERS = {"Accept": "text/html,application/xhtml+xml,application/xml;q=0.9,*/*;q=0.8", "Accept-Language": "de-DE,de;q=0.9,en;q=0.8"}


@dataclass(frozen=True)
class CrawlSettings:
    """How one kind of page is fetched. Each worker is a session of its own."""

    workers: int = 8
    attempts: int = 3
    timeout: float = 45.0
    jitter: tuple[float, float] = (0.05, 0.25)
    user_agent: str = "Mozilla/5.0 (X11; Linux x86_64)"
    proxy: str | None = None

    @classmethod
    def from_env(cls, prefix: str, timeout: float = 45.0, env: Mapping[str, str] = os.environ) -> CrawlSettings:
        """<PREFIX>_CONCURRENCY, _MAX_RETRIES, _TIMEOUT, and SCRAPE_MIN_DELAY, _MAX_DELAY, _USER_AGENT, _PROXY, _PROXY_USER, _PROXY_PASS for all kinds."""
        get = lambda name, default: type(default)(env.get(name, default))
        return cls(
            workers=get(f"{prefix}_CONCURRENCY", cls.workers),
            attempts=get(f"{prefix}_MAX_RETRIES", cls.attempts),
            timeout=get(f"{prefix}_TIMEOUT", timeout),
            jitter=(get("SCRAPE_MIN_DELAY", cls.jitter[0]), get("SCRAPE_MAX_DELAY", cls.jitter[1])),
            user_agent=get("SCRAPE_USER_AGENT", cls.user_agent),
            proxy=proxy_url(env.get("SCRAPE_PROXY"), env.get("SCRAPE_PROXY_USER"), env.get("SCRAPE_PROXY_PASS")),
        )

    def session(self) -> HttpSession:
        return HttpSession(HEADERS | {"User-Agent": self.user_agent}, self.timeout, self.proxy)

    def policy(self, healthy: Callable[[str, str], str | None] | None = None) -> Policy:
        return Policy(attempts=self.attempts, jitter=self.jitter, healthy=healthy)


@dataclass(frozen=True)
class Settings:
    """All of a deployment's settings."""

    root: str = "knowledge-base"
    catalogue_url: str | None = None
    least_links: int = V.LEAST_LINKS
    pages: CrawlSettings = field(default_factory=CrawlSettings)
    people: CrawlSettings = field(default_factory=lambda: CrawlSettings(timeout=30.0))
    catalogue: CrawlSettings = field(default_factory=lambda: CrawlSettings(workers=1, timeout=180.0))

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Settings:
        return cls(
            root=env.get("SPINDREL_ROOT", cls.root),
            catalogue_url=env.get("MODULE_CATALOG_URL"),
            least_links=int(env.get("MODULE_LINKS_MIN", V.LEAST_LINKS)),
            pages=CrawlSettings.from_env("SCRAPE", 45.0, env),
            people=CrawlSettings.from_env("PROFESSORS", 30.0, env),
            catalogue=CrawlSettings.from_env("MODULE_LINKS", 180.0, env),
        )


def healthy_module(html: str, url: str) -> str | None:
    """What is wrong with a module page, or None: a 200 without a module table is a failed session."""
    from spindrel.functions.pages import parse_module

    return parse_module(html, url)["parse_error"]


def healthy_event(html: str, url: str) -> str | None:
    from spindrel.functions.pages import parse_event

    return parse_event(html, url)["parse_error"]


def fetcher(settings: CrawlSettings, healthy: Callable[[str, str], str | None] | None = None):
    """The ``fetch`` function of plans.runs over HTTP."""
    from spindrel.sources.fetch import fetch

    return lambda urls: fetch(urls, settings.session, settings.workers, settings.policy(healthy))


def fetch_catalogue(settings: Settings) -> Callable[[], tuple[str, str]]:
    """The ``fetch`` of sources.links.rebuild_links: one page, tried as the settings say."""
    from spindrel.sources.fetch import fetch_one

    def once() -> tuple[str, str]:
        row = fetch_one(settings.catalogue.session(), settings.catalogue_url or "", settings.catalogue.policy())
        if not row[4]:
            raise ConnectionError(f"the catalogue didn't come: {row[5]}")
        return row[3], row[1]

    return once
