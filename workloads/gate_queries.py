"""Registered queries over landed trade lines and billing documents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from landgate.operators import quality as Q
from landgate.operators.drift import declared_types
from landgate.operators.drift import schema_drift as drift
from landgate.plans.gate import GateConfig, gate_records, run_gate
from landgate.schemas import BILLING, BILLING_KEY_FIELDS, CORRUPT, TRADE
from landgate.sources.landing import land
from landgate.sources.json_records import parse_documents, parse_records, read_json
from landgate.workspace import workspace
from workloads.load_queries import read_and_drop
from workloads.landed import (
    BILLS_JUDGED,
    DOCUMENTS_JUDGED,
    TRADES,
    TRADES_JUDGED,
    UNCLOSED,
    bill_records,
    document_files,
    land_trades,
    trade_lines,
    unclosed_files,
)

TRADE_KEYS = ("record_id", "trade_date", "quantity", "price", "currency", "trade_details")
TRADE_RULES = (
    Q.required("trade_date"),
    Q.required("record_id"),
    Q.numeric_text("record_id"),
    Q.within("quantity", 0, 1000),
)


def _trades(spark, sf):
    return read_json(spark, land_trades(spark, sf), TRADE, multiline=False)


def _valid_trades(spark, sf):
    return Q.split_valid(_trades(spark, sf))[0]


def _trade_gate(spark, sf, **more):
    cfg = GateConfig(
        land_trades(spark, sf), schema=TRADE, key_fields=TRADE_KEYS, rules=TRADE_RULES,
        multiline=False, **more,
    )
    return run_gate(spark, cfg)


def gate_counts(spark, sf):
    return Q.validation_counts(_trades(spark, sf))


def gate_null_stats(spark, sf):
    return Q.null_stats(_valid_trades(spark, sf), TRADE_KEYS)


def gate_rules(spark, sf):
    return Q.check_rules(_valid_trades(spark, sf), TRADE_RULES)


def gate_verdict(spark, sf):
    report = _trade_gate(spark, sf)
    return report.summary.select(
        "total", "valid", "invalid", F.size("violations").cast("bigint").alias("violated_rules"),
        "status",
    )


def gate_valid(spark, sf):
    return _trade_gate(spark, sf).valid.select(
        "record_id", "trade_date", "quantity", "price", "trade_details.order.order_type",
        "trade_details.market_data.volume",
    )


def gate_rejects(spark, sf):
    return Q.reject_texts(_trade_gate(spark, sf).invalid, width=20)


def reject_causes(spark, sf):
    """Causes that the gate counts, over trade lines and over document files of bills."""
    documents = run_gate(spark, GateConfig(_land_documents(spark, sf)))
    found = [("trades", _trade_gate(spark, sf)), ("bills", documents)]
    parts = [r.causes.select(F.lit(name).alias("source"), "cause", "path", "records") for name, r in found]
    return parts[0].union(parts[1])


def schema_drift(spark, sf):
    """What the raw trade lines hold against their declared schema, broken lines included."""
    return drift(trade_lines(spark, sf), TRADE, text="raw", skip=CORRUPT)


def reject_sample(spark, sf):
    return Q.reject_sample(Q.split_valid(_trades(spark, sf))[1], n=5, width=30)


OUTCOME_RULES = (Q.required("trade_date"),)
#: Last digits of the keys whose lines make each of four sources, one for each verdict.
OUTCOMES = {"clean": (4, 5, 6), "gaps": (3, 4, 5), "rejects": (0, 1, 4, 5), "both": (0, 1, 2, 3, 4)}


def gate_outcomes(spark, sf):
    answers = []
    for source, digits in OUTCOMES.items():
        lines = trade_lines(spark, sf).filter((F.col("k") % 10).isin(*digits))
        cfg = GateConfig(source, schema=TRADE, key_fields=("trade_date",), rules=OUTCOME_RULES)
        summary = gate_records(parse_records(lines, "raw", TRADE), cfg).summary
        answers.append(summary.select("source", "total", "valid", "invalid", "status"))
    return answers[0].union(answers[1]).union(answers[2]).union(answers[3])


def good_sample(spark, sf):
    shown = _valid_trades(spark, sf).select("record_id", "trade_date", "quantity")
    return shown.orderBy("record_id").limit(5)


def gate_tables(spark, sf):
    tag = uuid.uuid4().hex
    sides = {"valid": f"gate_valid_{tag}", "invalid": f"gate_invalid_{tag}"}
    _trade_gate(
        spark, sf, valid_table=sides["valid"], invalid_table=sides["invalid"],
        table_root=workspace(spark, "tables"),
    )
    counts = [
        read_and_drop(spark, t).agg(F.lit(side).alias("side"), F.count(F.lit(1)).alias("table_rows"))
        for side, t in sides.items()
    ]
    return counts[0].unionByName(counts[1])


def gate_column(spark, sf):
    parsed = parse_records(trade_lines(spark, sf), "raw", TRADE)
    return parsed.select("record_id", "quantity", F.col(CORRUPT).isNull().alias("accepted"))


def _documents(lines):
    return lines.groupBy(F.floor(F.col("k") / 100).alias("d")).agg(
        F.expr("concat('[', listagg(raw, ',') WITHIN GROUP (ORDER BY k), ']')").alias("doc")
    )


def gate_multiline(spark, sf):
    docs = _documents(trade_lines(spark, sf))
    return parse_documents(docs, "doc", TRADE).select(
        "record_id", "quantity", F.col(CORRUPT).alias("rejected")
    )


def _land_documents(spark, sf):
    """Document files with number-typed costs, nested text and all kinds of faults; returns their path."""
    texts = document_files(spark, sf).select("doc")
    path = workspace(spark, "documents")
    land(texts, path, "text")
    return path


def documents_read(spark, sf):
    df = read_json(spark, _land_documents(spark, sf), BILLING)
    return df.select("billing_account_id", "cost", F.col(CORRUPT).alias("rejected"))


def documents_unclosed(spark, sf):
    path = workspace(spark, "unclosed")
    land(unclosed_files(spark, sf), path, "text")
    df = read_json(spark, path, BILLING)
    # Behind a record that nothing closes stands the end of its array.
    text = F.regexp_replace(CORRUPT, r"[\s,\[\]]+$", "")
    return df.select("billing_account_id", text.alias("rejected"))


def documents_gate(spark, sf):
    report = run_gate(spark, GateConfig(_land_documents(spark, sf)))
    return report.summary.select("total", "valid", "invalid", "status")


def documents_rules(spark, sf):
    valid, _ = Q.split_valid(read_json(spark, _land_documents(spark, sf), BILLING))
    return Q.check_rules(valid, Q.BILLING_RULES)


def _bills(spark, sf):
    docs = _documents(bill_records(spark, sf))
    return parse_documents(docs, "doc", BILLING)


def billing_null_stats(spark, sf):
    valid, _ = Q.split_valid(_bills(spark, sf))
    return Q.null_stats(valid, BILLING_KEY_FIELDS)


def billing_rules(spark, sf):
    return Q.check_rules(Q.split_valid(_bills(spark, sf))[0], Q.BILLING_RULES)


def billing_verdict(spark, sf):
    report = gate_records(_bills(spark, sf), GateConfig("orders"))
    return report.summary.select("total", "valid", "invalid", "status")


def billing_labels(spark, sf):
    valid, _ = Q.split_valid(_bills(spark, sf))
    labels = valid.select("billing_account_id", "cost", F.inline("labels"))
    return labels.groupBy("key", "value").agg(
        F.count(F.lit(1)).alias("records"), F.count("billing_account_id").alias("accounts")
    )


GOOD_TRADES = f"{TRADES_JUDGED}, good AS (SELECT * FROM judged WHERE good)"


def _drift_sql() -> str:
    declared = {p: t.simpleString() for p, t in declared_types(TRADE, skip=CORRUPT).items()}
    kind = """CASE json_type(safe, '$.{}') WHEN 'VARCHAR' THEN 'string' WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer'
        WHEN 'DOUBLE' THEN 'number' ELSE lower(json_type(safe, '$.{}')) END"""
    seen = " UNION ALL ".join(
        f"SELECT '{p}' AS path, {kind.format(p, p)} AS found, count(*) AS records FROM parsed"
        f" WHERE json_type(safe, '$.{p}') IS NOT NULL GROUP BY 2"
        for p in declared if p != "$" and not p.endswith("[]")
    )
    names = ", ".join(f"('{p}', '{t}')" for p, t in declared.items())
    return f"""WITH parsed AS (
          SELECT json_valid(raw) AS readable, CASE WHEN json_valid(raw) THEN raw ELSE '{{}}' END AS safe FROM ({TRADES})),
        seen AS (SELECT '$' AS path, CASE WHEN readable THEN 'object' ELSE 'broken' END AS found, count(*) AS records
          FROM parsed GROUP BY 2 UNION ALL {seen}),
        names(path, declared) AS (VALUES {names})
        SELECT path, declared, found, CAST(coalesce(records, 0) AS BIGINT) AS records,
          CASE WHEN found IS NULL THEN 'never seen' WHEN found = 'broken' THEN 'broken' WHEN declared IS NULL THEN 'undeclared'
            WHEN found = 'null' THEN 'null' WHEN declared = 'string' THEN 'fits'
            WHEN declared LIKE 'struct%' AND found = 'object' OR declared LIKE 'array%' AND found = 'array' THEN 'fits'
            WHEN declared IN ('bigint', 'int', 'double') AND found = 'integer' OR declared = 'double' AND found = 'number'
              THEN 'fits' ELSE 'wrong type' END AS verdict
        FROM seen FULL JOIN names USING (path)"""


def _null_stats_sql(source: str, keys) -> str:
    parts = [
        f"""SELECT '{c}' AS field, count(*) FILTER (json_extract_string(raw, '$.{c}') IS NULL) AS nulls,
            100.0 * CAST(count(*) FILTER (json_extract_string(raw, '$.{c}') IS NULL) AS DOUBLE)
              / count(*) AS pct FROM good"""
        for c in keys
    ]
    return f"{source}, good AS (SELECT * FROM judged WHERE good) " + " UNION ALL ".join(parts)


def _rules_sql(source: str, rules: list[tuple[str, str, str]]) -> str:
    parts = [
        f"""SELECT '{name}' AS rule, n AS violations,
              concat(CAST(n AS STRING), ' {message}') AS message
            FROM (SELECT count(*) AS n FROM good WHERE {violated}) WHERE n > 0"""
        for name, violated, message in rules
    ]
    return f"{source}, good AS (SELECT * FROM judged WHERE good) " + " UNION ALL ".join(parts)


NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"

QUERIES = {
    "schema_drift": (schema_drift, _drift_sql()),
    "gate_counts": (
        gate_counts,
        TRADES_JUDGED
        + """SELECT count(*) AS total, count(*) FILTER (good) AS valid,
            count(*) FILTER (NOT good) AS invalid,
            100.0 * CAST(count(*) FILTER (good) AS DOUBLE) / count(*) AS valid_pct,
            100.0 * CAST(count(*) FILTER (NOT good) AS DOUBLE) / count(*) AS invalid_pct
            FROM judged""",
    ),
    "gate_null_stats": (gate_null_stats, _null_stats_sql(TRADES_JUDGED, TRADE_KEYS)),
    "gate_rules": (
        gate_rules,
        _rules_sql(
            TRADES_JUDGED,
            [
                (
                    "required(trade_date)",
                    "json_extract_string(raw, '$.trade_date') IS NULL",
                    "valid records with null trade_date",
                ),
                (
                    "required(record_id)",
                    "json_extract_string(raw, '$.record_id') IS NULL",
                    "valid records with null record_id",
                ),
                (
                    "numeric_text(record_id)",
                    f"NOT regexp_matches(json_extract_string(raw, '$.record_id'), '{NUMBER}')",
                    "records with non-numeric record_id",
                ),
                (
                    "within(quantity, 0, 1000)",
                    "NOT CAST(json_extract_string(raw, '$.quantity') AS DOUBLE) BETWEEN 0 AND 1000",
                    "records with quantity outside 0 to 1000",
                ),
            ],
        ),
    ),
    "gate_verdict": (
        gate_verdict,
        TRADES_JUDGED
        + """, counts AS (
            SELECT count(*) AS total, count(*) FILTER (good) AS valid,
              count(*) FILTER (NOT good) AS invalid,
              CAST(count(*) FILTER (good AND json_extract_string(safe, '$.trade_date') IS NULL) > 0 AS BIGINT)
              + CAST(count(*) FILTER (good AND json_extract_string(safe, '$.record_id') LIKE 'T%') > 0 AS BIGINT)
              + CAST(count(*) FILTER (good AND TRY_CAST(json_extract_string(safe, '$.quantity') AS DOUBLE) > 1000) > 0 AS BIGINT)
              AS violated_rules
            FROM judged)
          SELECT *, CASE WHEN invalid = 0 AND violated_rules = 0 THEN 'PASSED'
            WHEN invalid = 0 THEN 'PASSED WITH WARNINGS'
            WHEN violated_rules = 0 THEN 'PARTIAL' ELSE 'ISSUES' END AS status FROM counts""",
    ),
    "gate_valid": (
        gate_valid,
        GOOD_TRADES
        + """SELECT json_extract_string(raw, '$.record_id') AS record_id,
            json_extract_string(raw, '$.trade_date') AS trade_date,
            CAST(json_extract_string(raw, '$.quantity') AS DOUBLE) AS quantity,
            CAST(json_extract_string(raw, '$.price') AS DOUBLE) AS price,
            json_extract_string(raw, '$.trade_details.order.order_type') AS order_type,
            CAST(json_extract_string(raw, '$.trade_details.market_data.volume') AS BIGINT) AS volume
            FROM good""",
    ),
    "gate_rejects": (
        gate_rejects,
        TRADES_JUDGED
        + """SELECT CASE WHEN length(raw) > 20 THEN concat(substring(raw, 1, 20), '...') ELSE raw END
            AS rejected FROM judged WHERE NOT good""",
    ),
    "reject_causes": (
        reject_causes,
        f"""WITH trades AS (SELECT raw, json_valid(raw) AS readable,
              CASE WHEN json_valid(raw) THEN raw ELSE '{{}}' END AS safe FROM ({TRADES})),
            bills AS (SELECT * FROM ({DOCUMENTS_JUDGED} SELECT raw, good FROM judged))
          SELECT 'trades' AS source, CASE WHEN readable THEN 'wrong type' ELSE 'syntax' END AS cause,
            CASE WHEN readable THEN 'quantity' END AS path, count(*) AS records FROM trades
          WHERE NOT readable OR json_type(safe, '$.quantity') = 'VARCHAR' GROUP BY ALL
          UNION ALL
          SELECT 'bills', CASE WHEN raw LIKE '{{%' THEN 'syntax' ELSE 'stray text' END, NULL, count(*)
          FROM bills WHERE NOT good GROUP BY ALL""",
    ),
    "reject_sample": (
        reject_sample,
        TRADES_JUDGED
        + """SELECT CASE WHEN length(raw) > 30 THEN concat(substring(raw, 1, 30), '...') ELSE raw END
            AS rejected FROM (SELECT raw FROM judged WHERE NOT good ORDER BY raw LIMIT 5)""",
    ),
    "gate_outcomes": (
        gate_outcomes,
        TRADES_JUDGED
        + ", sources AS ("
        + " UNION ALL ".join(
            f"SELECT '{source}' AS source, * FROM judged WHERE k % 10 IN {digits}"
            for source, digits in OUTCOMES.items()
        )
        + """), counts AS (SELECT source, count(*) AS total, count(*) FILTER (good) AS valid,
              count(*) FILTER (NOT good) AS invalid,
              count(*) FILTER (good AND json_extract_string(safe, '$.trade_date') IS NULL) > 0 AS violated
            FROM sources GROUP BY source)
          SELECT source, total, valid, invalid, CASE WHEN invalid = 0 AND NOT violated THEN 'PASSED'
            WHEN invalid = 0 THEN 'PASSED WITH WARNINGS' WHEN NOT violated THEN 'PARTIAL' ELSE 'ISSUES' END
            AS status FROM counts""",
    ),
    "good_sample": (
        good_sample,
        GOOD_TRADES
        + """SELECT json_extract_string(raw, '$.record_id') AS record_id,
            json_extract_string(raw, '$.trade_date') AS trade_date,
            CAST(json_extract_string(raw, '$.quantity') AS DOUBLE) AS quantity
            FROM good ORDER BY record_id LIMIT 5""",
    ),
    "gate_tables": (
        gate_tables,
        TRADES_JUDGED
        + """SELECT CASE WHEN good THEN 'valid' ELSE 'invalid' END AS side, count(*) AS table_rows
            FROM judged GROUP BY 1""",
    ),
    "gate_column": (
        gate_column,
        TRADES_JUDGED
        + """SELECT json_extract_string(safe, '$.record_id') AS record_id,
            TRY_CAST(json_extract_string(safe, '$.quantity') AS DOUBLE) AS quantity,
            good AS accepted FROM judged""",
    ),
    "gate_multiline": (
        gate_multiline,
        TRADES_JUDGED
        + """, placed AS (SELECT *, k = max(k) OVER (PARTITION BY floor(k / 100)) AS closes FROM judged)
          SELECT json_extract_string(safe, '$.record_id') AS record_id,
            TRY_CAST(json_extract_string(safe, '$.quantity') AS DOUBLE) AS quantity,
            CASE WHEN good THEN NULL WHEN closes AND NOT json_valid(raw) THEN concat(raw, ']') ELSE raw END AS rejected
          FROM placed""",
    ),
    "documents_unclosed": (
        documents_unclosed,
        f"""WITH records AS ({UNCLOSED})
          SELECT CASE WHEN k % 50 NOT IN (10, 20) THEN concat('A', CAST(k AS VARCHAR)) END AS billing_account_id,
            CASE WHEN k % 50 IN (10, 20) THEN raw END AS rejected FROM records
          UNION ALL SELECT NULL, '}}' FROM records WHERE k % 50 = 30""",
    ),
    "documents_read": (
        documents_read,
        DOCUMENTS_JUDGED
        + """SELECT CASE WHEN good THEN json_extract_string(safe, '$.billing_account_id') END AS billing_account_id,
            CASE WHEN good THEN replace(regexp_extract(safe, '"cost":([^,]*)', 1), '"', '') END AS cost,
            CASE WHEN NOT good THEN raw END AS rejected FROM judged""",
    ),
    "documents_gate": (
        documents_gate,
        DOCUMENTS_JUDGED
        + """SELECT count(*) AS total, count(*) FILTER (good) AS valid,
            count(*) FILTER (NOT good) AS invalid, 'ISSUES' AS status FROM judged""",
    ),
    "documents_rules": (
        documents_rules,
        _rules_sql(
            DOCUMENTS_JUDGED,
            [
                (
                    "required(billing_account_id)",
                    "json_extract_string(safe, '$.billing_account_id') IS NULL",
                    "valid records with null billing_account_id",
                ),
                (
                    "numeric_text(cost)",
                    f"NOT regexp_matches(json_extract_string(safe, '$.cost'), '{NUMBER}')",
                    "records with non-numeric cost",
                ),
            ],
        ),
    ),
    "billing_null_stats": (billing_null_stats, _null_stats_sql(BILLS_JUDGED, BILLING_KEY_FIELDS)),
    "billing_rules": (
        billing_rules,
        _rules_sql(
            BILLS_JUDGED,
            [
                (
                    "required(billing_account_id)",
                    "json_extract_string(raw, '$.billing_account_id') IS NULL",
                    "valid records with null billing_account_id",
                ),
                (
                    "numeric_text(cost)",
                    f"NOT regexp_matches(json_extract_string(raw, '$.cost'), '{NUMBER}')",
                    "records with non-numeric cost",
                ),
            ],
        ),
    ),
    "billing_verdict": (
        billing_verdict,
        BILLS_JUDGED
        + """SELECT count(*) AS total, count(*) FILTER (good) AS valid,
            count(*) FILTER (NOT good) AS invalid,
            CASE WHEN count(*) FILTER (NOT good) > 0 THEN 'ISSUES' ELSE 'PASSED WITH WARNINGS' END
              AS status FROM judged""",
    ),
    "billing_labels": (
        billing_labels,
        BILLS_JUDGED
        + """SELECT json_extract_string(label, '$.key') AS key,
            json_extract_string(label, '$.value') AS value, count(*) AS records,
            count(json_extract_string(raw, '$.billing_account_id')) AS accounts
            FROM (SELECT raw, unnest(CAST(json_extract(raw, '$.labels') AS JSON[])) AS label
                  FROM judged WHERE good)
            GROUP BY 1, 2""",
    ),
}
