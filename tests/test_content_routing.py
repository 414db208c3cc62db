"""Content resolvers, page profiles from content, and routing by them."""

import base64
import json

from pyspark.sql import functions as F

from docloom.config import RoutingConfig
from docloom.operators import content_routing
from docloom.operators.content_routing import ContentAnalysis
from docloom.sources import content
from docloom.sources import messages as msg
from docloom.streaming import ingest

CONFIG = RoutingConfig(
    strategies={"short_form": "short", "form_heavy": "forms", "table_heavy": "tables", "scanned": "vision"}, fallback="rest", short_form_pages=3, short_form_density=0.3
)
MAIL = (
    b'From: a@b\nMIME-Version: 1.0\nContent-Type: multipart/mixed; boundary="x"\n\n--x\nContent-Type: text/plain; charset=nonsense\n\n' + b"w" * 1500
    + b"\n--x\nContent-Type: text/html\n\n<p>hi</p><table></table><input type=checkbox><img><img>\n--x\nContent-Type: image/png\n\nzz\n--x--\n"
)


def sent(spark, *bodies):
    rows = [(f"m{i}", "q", "s", json.dumps(b), 1) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "message_id string, queue_url string, stream string, body string, receive_count int").repartition(2)


def route(spark, bodies, **analysis):
    routed = content_routing.route_content(msg.accepted(msg.parse_messages(sent(spark, *bodies))), CONFIG, analysis=ContentAnalysis(**analysis))
    return {r.message_id: r for r in routed.collect()}


def inline(data):
    return base64.b64encode(data).decode()


def test_email_parts_decide(spark):
    found = route(spark, [
        {"object_key": "a.eml", "documentMetadata": {"pageCount": 9}, "documentBytes": inline(MAIL)},
        {"object_key": "b.txt", "documentMetadata": {"pageCount": 9}, "documentBytes": inline(MAIL)},
        {"object_key": "c.msg", "documentMetadata": {"pageCount": 9}},
        {"object_key": "d", "documentMetadata": {"contentType": "message/rfc822"}, "documentBytes": inline(b"no headers at all")},
    ])
    a = found["m0"]
    assert (a.page_count, a.total_tables, a.total_checkboxes, a.document_category) == (2, 1, 1, "table_heavy")
    assert abs(a.average_text_density - (0.5 + 2 / 4000) / 2) < 1e-9 and abs(a.average_image_density - (0.05 + 0.2) / 2) < 1e-9
    # sniffed as a message whatever its name; no content, no better profile than the declared one
    assert (found["m1"].page_count, found["m1"].mime_type) == (2, "message/rfc822")
    assert found["m2"].page_count == 9 and found["m3"].page_count == 1


def test_resolvers_fail_one_document_at_a_time(spark):
    calls = []

    def fetch(descriptor):
        calls.append(descriptor)
        if "bad" in descriptor["source_path"]:
            raise OSError("store is down")
        return MAIL if "good" in descriptor["source_path"] else b""

    def second(descriptor):
        if "worse" in descriptor["source_path"]:
            raise KeyError("x")
        return MAIL if "bad" in descriptor["source_path"] else None

    bodies = [{"object_key": f"{n}.eml"} for n in ("good", "bad", "bad-and-worse", "none")] + [{"object_key": "in.eml", "payload": "From: inline"}]
    found = route(spark, bodies, resolvers=(("_a", content.Fetcher("first", fetch)), ("_b", content.Fetcher("second", second))))
    pages = {k: r.page_count for k, r in found.items()}
    assert pages == {"m0": 2, "m1": 2, "m2": 1, "m3": 1, "m4": 1}
    errors = {k: [(e.resolver, e.error) for e in r.resolver_errors] for k, r in found.items()}
    assert errors["m0"] == errors["m3"] == errors["m4"] == []
    assert errors["m1"] == [("first", "OSError: store is down")] and [e[0] for e in errors["m2"]] == ["first", "second"]


def test_resolver_order_over_columns_joins_and_fetchers(spark):
    docs = spark.createDataFrame([(f"u{i}", b"col" if i == 0 else b"" if i == 1 else None) for i in range(5)], "source_uri string, held binary")
    stored = spark.createDataFrame([("u1", b"join"), ("u2", b"join")], "path string, content binary")
    chain = [
        ("held", None), ("f1", content.Fetcher("f1", lambda d: b"f1" if d["source_uri"] == "u2" else None)),
        ("content", lambda d: content.attach_content(d, stored)), ("f2", content.Fetcher("f2", lambda d: b"f2" if d["source_uri"] != "u4" else None)),
    ]
    resolved = content.resolve_content(docs, chain)
    assert set(resolved.columns) == {"source_uri", "resolver_errors", "content"}
    got = {r.source_uri: None if r.content is None else bytes(r.content) for r in resolved.collect()}
    assert got == {"u0": b"col", "u1": b"join", "u2": b"f1", "u3": b"f2", "u4": None}


def test_decoders_and_models_fall_back(spark):
    def pdf(data):
        if data == b"%PDF-broken":
            raise ValueError("broken")
        return [{"textDensity": 0.9, "tableCount": 2}] * 3

    bodies = [
        {"object_key": "a.pdf", "documentBytes": inline(b"%PDF-x"), "documentMetadata": {"pageCount": 7}},
        {"object_key": "b.pdf", "documentBytes": inline(b"%PDF-broken"), "documentMetadata": {"pageCount": 7}},
        {"object_key": "c.eml", "documentBytes": inline(MAIL), "documentMetadata": {"pageCount": 7}},
        {"object_key": "d.pdf", "documentMetadata": {"pageCount": 7}},
    ]
    found = route(spark, bodies, decoders={"pdf": pdf})
    assert {k: r.page_count for k, r in found.items()} == {"m0": 3, "m1": 7, "m2": 2, "m3": 7}
    assert found["m0"].document_category == "table_heavy"

    def model(documents):
        if any(d["source_path"] == "b.pdf" for d in documents):
            raise RuntimeError("model down")
        return [[{"text_density": "0.4"}] if d["source_path"] in ("c.eml", "d.pdf") else [] for d in documents]

    found = route(spark, bodies, decoders={"pdf": pdf}, model=model, slice_rows=4)
    assert {k: r.page_count for k, r in found.items()} == {"m0": 3, "m1": 7, "m2": 1, "m3": 1}
    assert abs(found["m3"].average_image_density - 0.6) < 1e-9


def test_stream_routes_by_content(spark, tmp_path):
    config = ingest.IngestConfig(str(tmp_path / "out"), str(tmp_path / "cp"), routing=CONFIG, content=ContentAnalysis())
    batch = sent(spark, {"object_key": "a.eml", "documentBytes": inline(MAIL)}).withColumn("sent_at", F.to_timestamp(F.lit("2024-01-01")))
    ingest.process_batch(batch, 0, config)
    [row] = spark.read.parquet(config.path("metadata")).collect()
    assert (row.page_count, row.document_category, len(json.loads(row.page_metrics))) == (2, "table_heavy", 2)
