"""Transports: how one request becomes (http_status, body, error).

A transport is a picklable callable taking the request as a dict (at
least ``url``, ``landing_name``, ``endpoint``) and returning
``(status, body_text_or_None, error_or_None)``.  It runs inside Spark
tasks, so it must not touch driver state.  The access token is given to
the transport, fills the template's token slot just before the call, and
is never written to the request plan, the payloads or the logs.
"""

from __future__ import annotations

import re
import urllib.error
import urllib.request

from sluice.sources.storage import open_filesystem, pyarrow_uri, qualify

TOKEN_SLOT = "{1}"
_UNSAFE = re.compile(r"[^A-Za-z0-9._-]")


def safe_file_name(name: str) -> str:
    """Landing file name readable through Hadoop paths: characters other than
    letters, digits, '.', '_' and '-' (':' and '/' above all) become '_'."""
    return _UNSAFE.sub("_", name)


_DECLARED = re.compile(rb"""^\s*<\?xml[^>]*?\sencoding\s*=\s*["']([A-Za-z0-9._-]+)["']""")
_MARKS = ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))


def decode_body(data: bytes) -> tuple[str | None, str | None]:
    """(text, error): by byte-order mark, else the XML declaration's encoding, else UTF-8; always strict.

    Bytes that do not fit are no payload: replaced characters would load as data.
    """
    declared = _DECLARED.match(data[:1024])
    encoding = next((e for mark, e in _MARKS if data.startswith(mark)),
                    declared.group(1).decode("ascii") if declared else "utf-8")
    try:
        return data.decode(encoding), None
    except (UnicodeDecodeError, LookupError) as e:
        return None, f"undecodable body: {type(e).__name__}: {e}"


class FileTransport:
    """Reads landed payload files: ``<root>/<endpoint>/<landing_name>``.

    Used for replays and tests (no network).  A missing file is a 404.
    ``root`` without a scheme is a local folder; on a cluster pass a full URI
    (``storage.qualified(spark, path)``).
    """

    def __init__(self, root: str, by_endpoint: bool = True):
        self.root = qualify(root.rstrip("/"))
        pyarrow_uri(self.root)  # an unknown store is an error here, not in every task
        self.by_endpoint = by_endpoint

    def __call__(self, request: dict):
        from pyarrow import fs as pafs
        filesystem, base = open_filesystem(self.root)
        parts = [base, request["endpoint"]] if self.by_endpoint else [base]
        path = "/".join([*parts, safe_file_name(request["landing_name"])])
        try:
            info = filesystem.get_file_info(path)
            if info.type != pafs.FileType.File:
                return 404, None, f"not found: {request['landing_name']}"
            with filesystem.open_input_stream(path) as f:
                body, error = decode_body(f.read())
                return 200, body, error
        except OSError as e:  # unreadable landing file
            return None, None, f"{type(e).__name__}: {e}"


class HttpTransport:
    """HTTP GET with the standard library; non-200 answers carry no body."""

    def __init__(self, token: str | None = None, timeout: float = 600.0,
                 headers: dict[str, str] | None = None):
        self._token = token
        self.timeout = timeout
        self.headers = dict(headers or {})

    def __repr__(self):  # keep the token out of logs and plans
        return f"HttpTransport(timeout={self.timeout})"

    def _scrub(self, text: str) -> str:
        return text.replace(self._token, "***") if self._token else text

    def __call__(self, request: dict):
        url = request["url"].replace(TOKEN_SLOT, self._token or "")
        if not url.lower().startswith(("http://", "https://")):
            return None, None, "ValueError: only http and https requests are sent"
        try:
            req = urllib.request.Request(url, headers=self.headers, method="GET")
            with urllib.request.urlopen(req, timeout=self.timeout) as resp:
                status = resp.status
                data = resp.read()
        except urllib.error.HTTPError as e:
            return e.code, None, f"HTTP {e.code}"
        except (urllib.error.URLError, OSError, ValueError) as e:
            return None, None, self._scrub(f"{type(e).__name__}: {e}")
        if status != 200:
            return status, None, f"HTTP {status}"
        body, error = decode_body(data)
        return status, body, error
