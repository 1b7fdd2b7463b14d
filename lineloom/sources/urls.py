"""Whether a URL may be fetched: pure checks, no network."""

from __future__ import annotations

import ipaddress
from urllib.parse import urlsplit

MOST_BYTES, MOST_REDIRECTS, SECONDS = 5 << 30, 5, 600


def private_address(text: str) -> bool:
    """Whether an address isn't one of the public network; what isn't an address counts as private."""
    try:
        a = ipaddress.ip_address(text.strip("[]").partition("%")[0])
    except ValueError:
        return True
    a = getattr(a, "ipv4_mapped", None) or a
    return not a.is_global or a.is_multicast


def check_url(url: str, resolve=None) -> str | None:
    """Why a URL may not be fetched, or None. resolve gives the addresses of a host; all of them must be public."""
    try:
        u = urlsplit(url)
        host = u.hostname
        u.port  # noqa: B018
    except ValueError:
        return "malformed"
    if u.scheme not in ("http", "https"):
        return "scheme"
    if u.username or u.password:
        return "credentials"
    if not host or host == "localhost" or host.endswith((".local", ".internal")):
        return "host"
    try:
        ipaddress.ip_address(host)
        found = [host]
    except ValueError:
        found = resolve(host) if resolve else []
        if resolve and not found:
            return "unresolved"
    return "private" if any(map(private_address, found)) else None
