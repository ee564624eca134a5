"""Metrics over HTTP: the latest rendered text, and a scrape of such a page."""

from __future__ import annotations

import threading
import urllib.request
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import DataFrame, SparkSession

from . import exposition


class Exporter:
    """Serves ``/metrics`` and ``/``; other paths are not found. ``update`` takes the series (name, labels,
    value), so it serves as the function of ``foreachBatch``."""

    def __init__(self, port: int = 0, kinds: dict[str, str] | None = None) -> None:
        self.kinds, self.text = kinds, ""
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self) -> None:
                good = self.path in ("/", "/metrics")
                body = outer.text.encode() if good else b"not found"
                self.send_response(200 if good else 404)
                self.send_header("Content-Type", "text/plain; version=0.0.4")
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *_) -> None:
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", port), Handler)
        self.port = self.server.server_port
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def update(self, series: DataFrame, batch: int = 0) -> None:
        rows = exposition.render(series, self.kinds).orderBy("name").collect()  # a text for each family
        self.text = "".join(r.text + "\n" for r in rows)

    def close(self) -> None:
        self.server.shutdown()
        self.server.server_close()


def scrape(spark: SparkSession, url: str, timeout: float = 2.0) -> DataFrame:
    """The samples of a page, parsed; an error status raises."""
    with urllib.request.urlopen(url, timeout=timeout) as page:
        lines = page.read().decode().split("\n")
    return exposition.parse_exposition(spark.createDataFrame(list(enumerate(lines)), "pos int, line string"))
