"""HTTP service over the files of a run: results, a new run, and the test of one pair. JSON in and out.

GET /api/results, POST /api/run-pipeline, POST /api/test-match. What is sent back is collected: it is meant for viewers.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from .operators.features import FEATURES
from .plans.resolve import results_view, run_pipeline, score_pairs
from .sources.tables import ROW_ORDER, parse_requests, read_report, read_tsv, read_tsv_or_empty

RESULT_COLUMNS = ("source1_entity_id", "matched_entity_ids")


@dataclass
class Service:
    spark: SparkSession
    train_dir: str
    test_dir: str
    output_dir: str

    def report(self) -> dict:
        """The report of the last run, or the values shown where there is none."""
        row = read_report(self.spark, f"{self.output_dir}/experiment_report.json").first().asDict(recursive=True)
        row["top_features"] = [[k, float(v)] for k, v in row["top_features"] or []]
        return {k: v for k, v in row.items() if v is not None}

    def results(self) -> dict:
        """report, and of every source-1 entity its fields and matches; entities without results have no matches."""
        try:
            s1 = read_tsv(self.spark, f"{self.test_dir}/test_source1.tsv", na=False, order=True)
        except PySparkException:
            return {"report": self.report(), "results": []}
        found = read_tsv_or_empty(self.spark, f"{self.output_dir}/matching_results.tsv", RESULT_COLUMNS)
        view: DataFrame = results_view(s1, found).orderBy(ROW_ORDER).drop(ROW_ORDER)
        return {"report": self.report(), "results": [r.asDict() for r in view.toLocalIterator()]}

    def run(self) -> dict:
        out = run_pipeline(self.spark, self.train_dir, self.test_dir, self.output_dir)
        return {"success": True, "metrics": out["metrics"], "validation_passed": out["validation_passed"]}

    def test_match(self, body: bytes) -> dict:
        """features, probability, threshold (the report's) and is_match of {entity_a, entity_b}."""
        json.loads(body)  # a body that is no JSON is an error, not an empty pair
        request = parse_requests(self.spark.createDataFrame([(body.decode(),)], "request string"))
        r = score_pairs(request, self.report()["best_threshold"]).first()
        return {"features": {k: r[k] for k in FEATURES}, "probability": r.probability, "threshold": r.threshold, "is_match": r.is_match}

    def handle(self, method: str, path: str, body: bytes = b"") -> tuple[int, dict]:
        """Status and answer of a request."""
        path = path.partition("?")[0]
        if (method, path) == ("GET", "/api/results"):
            return 200, self.results()
        if (method, path) == ("POST", "/api/run-pipeline"):
            try:
                return 200, self.run()
            except Exception as e:  # noqa: BLE001  whatever it is, the caller is told
                return 500, {"success": False, "error": str(e)}
        if (method, path) == ("POST", "/api/test-match"):
            try:
                return 200, self.test_match(body or b"{}")
            except Exception as e:  # noqa: BLE001
                return 400, {"error": str(e)}
        return 404, {"error": "not found"}


def server(service: Service, port: int) -> ThreadingHTTPServer:
    class Handler(BaseHTTPRequestHandler):
        def _send(self, status: int, answer: dict | None) -> None:
            data = b"" if answer is None else json.dumps(answer).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.send_header("Access-Control-Allow-Origin", "*")
            self.send_header("Access-Control-Allow-Methods", "GET, POST, OPTIONS")
            self.send_header("Access-Control-Allow-Headers", "Content-Type")
            self.send_header("Cache-Control", "no-store")
            self.end_headers()
            self.wfile.write(data)

        def do_OPTIONS(self) -> None:
            self._send(200, None)

        def do_GET(self) -> None:
            self._send(*service.handle("GET", self.path))

        def do_POST(self) -> None:
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            self._send(*service.handle("POST", self.path, body))

        def log_message(self, *args: object) -> None:
            pass

    return ThreadingHTTPServer(("127.0.0.1", port), Handler)


def serve(spark: SparkSession, train_dir: str, test_dir: str, output_dir: str, port: int = 8000) -> None:
    with server(Service(spark, train_dir, test_dir, output_dir), port) as s:
        s.serve_forever()
