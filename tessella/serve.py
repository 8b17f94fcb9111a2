"""A small web server for tilesets: tiles, their documents, and a list that is made anew for each request."""

from __future__ import annotations

import json
import os
from functools import partial
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer

#: Types that the platform's own table may lack or get wrong.
TYPES = {".json": "application/json", ".webp": "image/webp", ".png": "image/png", ".js": "text/javascript", ".html": "text/html; charset=utf-8"}


def _named(document: str) -> str | None:
    """The name that a tileset's document gives, "" if it gives none; None if it can't be read."""
    with open(document, encoding="utf-8") as f:
        text = f.read()
    try:
        return json.loads(text).get("name") or ""
    except (ValueError, AttributeError):
        return None


def listed(root: str) -> list[dict]:
    """``path, name, valid`` of the tilesets in ``root`` and right below it, the root's first.

    One whose document can't be read is listed too, by its folder's name, and marked.
    """
    places = {"": root} | {e.name: e.path for e in sorted(os.scandir(root), key=lambda e: e.name) if e.is_dir()}
    documents = {path: os.path.join(where, "metadata.json") for path, where in places.items()}
    names = {path: _named(d) for path, d in documents.items() if os.path.isfile(d)}
    return [{"path": path, "name": name or path or "tileset", "valid": name is not None} for path, name in names.items()]


class TileHandler(SimpleHTTPRequestHandler):
    """Files of a folder for any origin; documents and pages aren't cached, as they change while tiles do not."""

    extensions_map = SimpleHTTPRequestHandler.extensions_map | TYPES

    def do_GET(self) -> None:
        if self.path.split("?")[0] != "/tilesets.json":
            super().do_GET()
            return
        body = json.dumps(listed(self.directory)).encode()
        self.send_response(200)
        self.send_header("Content-Type", TYPES[".json"])
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def end_headers(self) -> None:
        self.send_header("Access-Control-Allow-Origin", "*")
        if self.path.split("?")[0].endswith((".json", ".html", "/")):
            self.send_header("Cache-Control", "no-cache")
        super().end_headers()

    def log_message(self, *args: object) -> None:
        pass


def server(root: str, host: str = "127.0.0.1", port: int = 8000) -> ThreadingHTTPServer:
    """A server of ``root``, not yet running; port 0 takes a free one."""
    if not os.path.isdir(root):
        raise FileNotFoundError(root)
    return ThreadingHTTPServer((host, port), partial(TileHandler, directory=root))
