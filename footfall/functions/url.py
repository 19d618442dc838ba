"""Site of a page address."""

from __future__ import annotations

# Scheme, and host (with a dot, without user info and port), of a page address; the host may stand without a scheme.
SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"
HOST = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?(?:[^/?#@]*@)?([^/?#:@]*\.[^/?#:@]+)"


def uri_host(url: str) -> str:
    """SQL for `scheme://host` of an address that starts with http, else ''.

    Pattern matching rather than `parse_url`: addresses come from browsers as they are, and a
    blank or an unescaped character in the query must not lose the host.
    """
    site = f"concat(regexp_extract({url}, r'{SCHEME}', 1), '://', regexp_extract({url}, r'{HOST}', 1))"
    return f"CASE WHEN startswith({url}, 'http') THEN {site} ELSE '' END"
