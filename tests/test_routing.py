"""Profiles, categories, strategies, media types and rules."""

import base64
import io
import json
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from docloom.config import RoutingConfig, Strategy
from docloom.functions import binary
from docloom.operators import layout, routing, rule_index
from docloom.sources import messages as msg
from docloom.sources import overrides

UNIT = RoutingConfig(
    strategies={c: f"{c}_parser" for c in ("short_form", "long_form", "scanned", "table_heavy", "form_heavy", "unknown")},
    fallback="fallback_strategy", short_form_pages=5, long_form_pages=50,
    page_limits={"short_form": 4, "long_form": 120, "table_heavy": 3, "form_heavy": 4},
)
SUITE = RoutingConfig(
    strategies={
        "short_form": "azure_general", "long_form": "azure_longform", "table_heavy": "azure_tables", "form_heavy": "azure_forms",
    },
    short_form_pages=5, long_form_pages=15, page_limits={"short_form": 4, "long_form": 120, "table_heavy": 10, "form_heavy": 6},
)


def messages(spark, bodies):
    rows = [(f"m{i}", "q", "s", b if isinstance(b, str) else json.dumps(b), 1) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "message_id string, queue_url string, stream string, body string, receive_count int")


def rules(spark, text):
    return overrides.layer_rules(overrides.rules_from_json(spark.createDataFrame([(text,)], "payload string")))


def route(spark, bodies, config=UNIT, rule_text=None):
    table = rules(spark, rule_text) if rule_text else None
    routed = routing.route_messages(msg.accepted(msg.parse_messages(messages(spark, bodies))), config, table)
    return {r.message_id: r for r in routed.collect()}


def pages(n, text, image, table=0.0, **extra):
    return [{"textDensity": text, "imageDensity": image, "tableDensity": table, **extra} for _ in range(n)]


def body(key, layout_pages=None, **extra):
    metadata = {"layout": {"pages": layout_pages}} if layout_pages is not None else {}
    return {"object_key": key, "documentMetadata": metadata, **extra}


def test_metadata_only_profile(spark):
    r = route(spark, [{"object_key": "a.pdf", "documentMetadata": {"pageCount": 2, "layout": {"textDensity": 0.6, "imageDensity": 0.4}}}])["m0"]
    assert (r.page_count, r.average_text_density, r.total_tables, r.table_page_ratio) == (2, pytest.approx(0.6), 0, 0.0)


def test_request_beats_pattern(spark):
    pair = [{"textDensity": 0.8}, {"textDensity": 0.7}]
    text = '{"pattern": "contract", "strategy": "contract_parser"}'
    found = route(
        spark,
        [
            body("contract.pdf", pair, parser_override="force_parser"), body("contract.pdf", pair), body("contract.pdf", pair, routing={"parser_override": "nested"}),
            body("contract.pdf", pair, parser_override=None, routing={"parser_override": "nested"}), body("contract.pdf", pair, overrides={"parser_override": "other"}),
        ],
        rule_text=text,
    )
    first = found["m0"]
    assert (first.document_category, first.parser_strategy, first.strategy_reason, first.overrides_applied) == ("short_form", "force_parser", "request_override", "request")
    assert (found["m1"].parser_strategy, found["m1"].overrides_applied) == ("contract_parser", "pattern:contract")
    assert found["m2"].parser_strategy == "nested"
    # a top-level key given as null hides the nested one
    assert (found["m3"].request_override, found["m3"].parser_strategy) == (None, "contract_parser")
    assert found["m4"].parser_strategy == "other"


def test_threshold_redirect(spark):
    r = route(spark, [body("t.pdf", pages(5, 0.9, 0.1, tableCount=1))])["m0"]
    assert (r.document_category, r.parser_strategy, r.strategy_reason) == ("table_heavy", "fallback_strategy", "page_threshold_exceeded")
    assert (r.total_tables, r.table_page_ratio, r.strategy_max_pages) == (5, 1.0, 3)


def test_end_to_end_scenarios(spark):
    form = [dict(textDensity=0.55, imageDensity=0.15, tableDensity=0.35, checkboxCount=1, radioButtonCount=1)] * 2
    found = route(
        spark,
        [
            body("report.pdf", pages(18, 0.72, 0.12, 0.08)), body("budget.xlsx", pages(1, 0.25, 0.1, 0.95, tableCount=4)),
            body("catalog.pdf", pages(1, 0.9, 0.05, 0.1)), body("Invoice-7.pdf", pages(1, 0.85, 0.05, 0.15)), body("form.eml", form),
            body("forced.eml", pages(2, 0.45, 0.1, 0.05), parser_override="force_manual_route"),
        ],
        SUITE,
        '[{"pattern": "(?i)invoice", "strategy": "invoice_override", "model": "custom-invoice-v1"}]',
    )
    shown = [(r.document_category, r.parser_strategy, r.strategy_reason) for _, r in sorted(found.items())]
    assert shown == [
        ("long_form", "azure_longform", "category_default"), ("table_heavy", "azure_tables", "category_default"),
        ("short_form", "azure_general", "category_default"), ("short_form", "invoice_override", "config_pattern_override"),
        ("form_heavy", "azure_forms", "category_default"), ("unknown", "force_manual_route", "request_override"),
    ]
    assert found["m3"].parser_model == "custom-invoice-v1"


def test_page_payload_spellings(spark):
    payload = [
        {"text_density": "0.2", "textDensity": 0.9, "table_density": 0.7, "tableDensity": 0.1, "tableCount": 0, "table_count": 3, "charCount": "x", "index": 7},
        {"image_density": None, "textDensity": 0.4}, {},
    ]
    laid = layout.message_layout(msg.accepted(msg.parse_messages(messages(spark, [body("a", payload)]))))
    got = laid.select(F.explode("listed_pages").alias("p")).select("p.*").collect()
    assert [(p["index"], p.text_density, p.table_density, p.table_count, p.char_count) for p in got] == [
        (7, 0.2, 0.1, 3, None), (1, 0.4, 0.0, 0, None), (2, 0.5, 0.0, 0, None),
    ]
    assert [p.image_density for p in got] == pytest.approx([0.8, 0.6, 0.5])


def test_page_count_ladder(spark):
    bodies = [
        {"object_key": "a", "documentMetadata": {"pageCount": "many"}, "page_count": 9}, {"object_key": "a", "page_count": 9}, {"object_key": "a", "pageCount": "4"},
        {"object_key": "a"}, {"object_key": "a", "documentMetadata": {"layout": {"pages": []}, "pageCount": 3}}, {"object_key": "a", "documentMetadata": {"pageCount": None}, "page_count": 9},
    ]
    assert [r.page_count for _, r in sorted(route(spark, bodies).items())] == [1, 9, 4, 1, 3, 1]


def test_message_rejections(spark):
    bodies = ['{"a": 1', '{"object_key": "x"} tail', "[1]", '{"object_key": ""}', '{"source_path": "p"}', '{"source_uri": "s3://b/k"}', '{"s3": {"object": {"key": "k"}}, "object_key": "other"}', "{}"]
    parsed = {r.message_id: r for r in msg.parse_messages(messages(spark, bodies)).collect()}
    assert [parsed[f"m{i}"].failure_reason for i in range(8)] == ["invalid_json", "invalid_json", "missing_object_key", "missing_object_key", None, None, None, "missing_object_key"]
    assert parsed["m6"].source_path == "k"
    strict = msg.parse_messages(messages(spark, bodies[5:6]), accept_source_uri=False).collect()[0]
    assert strict.failure_reason == "missing_object_key"


def test_unwrap_notifications(spark):
    inner = {"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "k1"}}}, {"s3": {"object": {"key": "k2"}}}]}
    sent = messages(spark, [{"Message": json.dumps(inner)}, {"object_key": "flat"}])
    found = msg.parse_messages(msg.unwrap_notifications(sent)).collect()
    assert sorted(r.source_path for r in found) == ["flat", "k1", "k2"]


def _zip(*names):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for name in names:
            archive.writestr(name, "x")
    return data.getvalue()


def test_media_types(spark):
    office = "application/vnd.openxmlformats-officedocument."
    cases = [
        (b"%PDF-1.7\n...", "application/pdf"), (_zip("word/document.xml"), office + "wordprocessingml.document"), (_zip("PPT/a.xml"), office + "presentationml.presentation"),
        (_zip("xl/a"), office + "spreadsheetml.sheet"), (_zip("a.txt"), "application/zip"), (b"PK\x03\x04broken", "application/zip"), (b"\xd0\xcf\x11\xe0..", "application/msword"),
        (b"  <!doctype html><p>", "text/html"), (b"<p><html>", "text/html"), (b"<?xml version='1'?>", "application/xml"), (b"From: a@b", "message/rfc822"),
        (b"plain words", "text/plain"), (bytes(range(128, 250)), None), (b"", None),
    ]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, data binary")
    got = {r.i: r.m for r in rows.select("i", binary.mime_from_bytes("data").alias("m")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[1] for c in cases]


def test_inline_payload_keys(spark):
    pdf = base64.b64encode(b"%PDF-1.7\n...").decode()
    bodies = [
        {"object_key": "x", "documentBytes": pdf}, {"object_key": "x", "payload": base64.b64encode(_zip("word/a")).decode()},
        {"object_key": "x", "document_content": base64.b64encode(b"<!doctype html>").decode()}, {"object_key": "x.csv"}, {"object_key": "x"},
        {"object_key": "x", "documentBytes": "", "documentMetadata": {"inline_content": pdf}}, {"object_key": "x", "documentBytes": pdf, "documentMetadata": {"mimeType": "a/b"}},
    ]
    described = msg.describe(msg.accepted(msg.parse_messages(messages(spark, bodies))))
    got = {r.message_id: r.mime_type for r in described.collect()}
    assert [got[f"m{i}"].split(".")[-1] for i in range(7)] == ["application/pdf", "document", "text/html", "text/csv", "application/octet-stream", "application/pdf", "a/b"]


def test_html_counts(spark):
    html = "<html><script>var a='<b>'</script><!-- <table> --><table><tr><td>x &amp; y</td></tr></table><input type='checkbox'><INPUT TYPE=RADIO><img src='a'/></html>"
    row = spark.createDataFrame([(html,), (None,)], "html string").select(layout.html_layout_counts("html").alias("c")).select("c.*").collect()
    assert tuple(row[0])[1:] == (1, 1, 1, 1) and row[0].char_count == len("var a='<b>'x & y")
    assert tuple(row[1]) == (0, 0, 0, 0, 0)


ODD_PATTERNS = [
    "invoice", "^in", "in$", "(?i)INVOICE", "(?i:Scan)", "a|b", "(foo|bar)baz", "x+y", "xy*z", "xy?", "q{2}", "q{0,3}r", "[abc]d", "[]x]z", "[^0-9]{3}k", r"\d{4}-\d\d",
    r"a\.b", r"\bword\b", ".*", "", "tab\tend", "(?s)n.o", "(?x)a b", "é{1,2}t", "(?i)É", "(?=look)l", "(?<!no)yes", "a{,2}b", "ab{1,}c", "(a)(b)c", "nested(a(b)c)?end",
    r"[\]]q", "[a&&b]", "[", "(", "a**", "a++b", "plus+", "{", r"\Qa.b\E", r"end\\", "K", "(?i)k", "ſ", "(?i)s", "a\\/b",
]
ODD_KEYS = [
    "", None, "invoice", "my INVOICE.pdf", "in", "xin", "inx", "scan", "SCANNED", "foobaz", "barbaz", "baz", "xxy", "xz", "xyyz", "x", "qq", "r", "qqqqr", "ad", "zd", "]z", "xz", "abck",
    "2024-01-02", "a.b", "axb", "a word here", "sword", "tab\tend", "n\no", "ab", "a b", "éét", "É", "é", "look", "l", "yes", "noyes", "b", "a{,2}b", "abbbc", "abc",
    "nestedend", "nestedabcend", "]q", "aab", "plusss", "{", "end\\", "K", "\u212a", "k", "ſ", "s", "S", "a/b", "a\\/b", "x" * 5000 + "invoice",
]


def test_index_equals_expression(spark, monkeypatch):
    entries = [(i, p, f"s{i}", None, i) for i, p in enumerate(ODD_PATTERNS * 2)]
    table = overrides.layer_rules(overrides.rules_from_table(spark.createDataFrame(entries, "position long, pattern string, strategy string, model string, max_pages int")))
    docs = spark.createDataFrame([(i, k) for i, k in enumerate(ODD_KEYS)], "id long, source_path string").repartition(3)

    def found(part):
        return {r.id: r["_rule"] and r["_rule"].asDict() for r in routing.match_rules(docs, part).collect()}

    # every pattern alone, then all of them in priority order
    for first in range(0, len(ODD_PATTERNS), 6):
        few = table.where(F.col("max_pages").between(first, first + 5))
        want = found(few)
        with monkeypatch.context() as patch:
            patch.setattr(routing, "RULES_PER_PASS", 0)
            assert found(few) == want
    want = found(table)
    monkeypatch.setattr(routing, "RULES_PER_PASS", 0)
    assert found(table) == want and any(want.values())


def test_needed_literals():
    for pattern in ODD_PATTERNS:
        try:
            compiled = re.compile(pattern)
        except re.error:
            continue
        text, folded, whole = rule_index.needed_literal(pattern)
        for key in filter(None, ODD_KEYS):
            hit = compiled.search(key) is not None
            if text is not None and hit and not folded:
                assert text in key, (pattern, key)
            if whole:
                assert hit == (text in key), (pattern, key)
    assert rule_index.needed_literal("^2-high/.*9[.]pdf$") == ("2-high/", False, False)
    assert rule_index.needed_literal("(?i)URGENT") == ("URGENT", True, False)
    assert rule_index.needed_literal(r"a\.b") == ("a.b", False, True)


def test_index_plan_does_not_grow(spark):
    docs = spark.createDataFrame([("k7",), ("k1234",), ("none",)], "source_path string")

    def planned(count):
        entries = [(i, f"k{i}$", f"s{i}") for i in range(count)]
        table = overrides.layer_rules(overrides.rules_from_table(spark.createDataFrame(entries, "position long, pattern string, strategy string")))
        matched = routing.match_rules(docs, table)
        assert {r.source_path: r["_rule"] and r["_rule"].name for r in matched.collect()} == {"k7": "s7", "k1234": "s1234" if count > 1234 else None, "none": None}
        return len(matched._jdf.queryExecution().optimizedPlan().toString())

    assert abs(planned(3000) - planned(500)) < 200


def test_no_task_holds_the_rules(spark, monkeypatch):
    """Rules meet keys in a join; anchors of many keys are cut, and long ones are told by their beginning."""
    long = "long" * 30
    patterns = ["[.]pdf$", "a", "(?i)B7", f"{long}1", f"{long}2$", r"\d\d[.]", "7[.]pdf", "é7"]
    table = overrides.layer_rules(overrides.rules_from_table(spark.createDataFrame([(i, p, f"s{i}") for i, p in enumerate(patterns)], "position long, pattern string, strategy string")))
    keys = [f"{c}{i}.{e}" for c in ("a", "b", "B", "é", long) for i in (1, 2, 7, 17) for e in ("pdf", "txt")] + ["", None, None, "b7.txt", "b7.txt", long]
    docs = spark.createDataFrame(list(enumerate(keys)), "id long, source_path string")

    def found():
        matched = routing.match_rules(docs, table)
        return matched, {r.id: r["_rule"] and r["_rule"].name for r in matched.collect()}

    _, want = found()
    monkeypatch.setattr(routing, "RULES_PER_PASS", 0)
    monkeypatch.setattr(rule_index, "CROWD", 2)
    matched, got = found()
    assert got == want and len(set(got.values())) > 5
    assert "ArrowEvalPython" not in matched._jdf.queryExecution().optimizedPlan().toString()


def test_rejected_rules(spark):
    entries = [{"pattern": p, "strategy": "s"} for p in ("ok", "(", "a**", "[a-")]
    assert sorted(r.pattern for r in overrides.rejected_rules(rules(spark, json.dumps(entries))).collect()) == ["(", "[a-", "a**"]


def test_config_validation():
    with pytest.raises(ValueError):
        RoutingConfig(mode="other")
    with pytest.raises(ValueError):
        RoutingConfig(page_limits={"scanned": 3})
    config = RoutingConfig(strategies={"bogus": "b"}, fallback={"name": "f", "max_pages": "7"})
    assert config.strategy_by_category()["scanned"] == Strategy("b") and config.fallback_strategy() == Strategy("f", None, 7)


def test_model_metrics_fall_back(spark):
    docs = spark.createDataFrame([("a",), ("b",)], "document_id string")

    def infer(batch):
        import pandas as pd

        if "b" in set(batch["document_id"]):
            raise RuntimeError("model down")
        return pd.DataFrame([("a", 0, 0.5, 0.1, 0.0, 10, 0, 0, 0, 0)], columns=["document_id", "index", "text_density", "image_density", "table_density", "char_count", "table_count", "image_count", "checkbox_count", "radio_button_count"])

    modelled = layout.profile_pages(layout.model_metrics(docs.repartition(2, "document_id"), infer, "document_id"), ["document_id"])
    heuristic = docs.withColumns({"page_count": F.lit(9).cast("long")})
    got = {r.document_id: r.page_count for r in layout.with_fallback(modelled, heuristic, "document_id").collect()}
    assert set(got) == {"a", "b"} and got["b"] == 9


def test_bodies_are_read_once(spark):
    body = json.dumps({"object_key": "a/b.pdf", "documentMetadata": {"pageCount": 3, "layout": {"textDensity": 0.4}}})
    # made by an expression, as a filter pushed below it would make and read it again
    sent = spark.range(5).select(F.concat(F.lit("m"), F.col("id")).alias("message_id"), *[F.lit(c).alias(c) for c in ("queue_url", "stream")], F.when(F.col("id") > 0, F.lit(body)).otherwise("{").alias("body"), F.lit(1).alias("receive_count"))
    routed = routing.route_messages(msg.accepted(msg.parse_messages(sent)), RoutingConfig())
    plan = routing.message_metadata(routed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert routed.count() == 4


def test_pages_as_text(spark):
    layouts = ({"textDensity": "nan"}, {"textDensity": 1e-9, "tableDensity": 2}, {}, {"pages": [{"textDensity": 0.25, "index": 7}, {"charCount": 3}]}, {"pages": []})
    bodies = [json.dumps({"object_key": "k", "documentMetadata": {"pageCount": n, "layout": x}}) for n in (1, 2, 12) for x in layouts]
    sent = spark.createDataFrame([(b,) for b in bodies], "body string")
    laid_out = layout.message_layout(msg.parse_messages(sent))
    rows = laid_out.select(F.to_json(layout.page_array(), {"ignoreNullFields": "false"}).alias("want"), layout.page_array_json().alias("got")).collect()
    assert len(rows) == len(bodies) and all(r.got == r.want for r in rows)
    routed = routing.route_messages(msg.accepted(msg.parse_messages(sent.selectExpr("'m' AS message_id", "'q' AS queue_url", "body"))), RoutingConfig())
    whole, text = (sorted(r.routing for r in routing.routing_record(routed, *pages).collect()) for pages in ([layout.page_array()], []))
    assert whole == text
