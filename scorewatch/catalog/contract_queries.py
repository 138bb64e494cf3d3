"""Contracts on token text and on requests."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions.decisions import binarise, unbinarise
from ..functions.fixed import LINE_BREAK, WHITESPACE
from ..functions.text import is_blank, token_count, tokens
from ..operators import contract as contracts, perturb
from ..operators.contract import Contract, Field
from ..operators.features import value_counts
from ..session import materialise
from ..sources.fingerprint import text_fingerprint
from ..sources.text import token_lines
from . import views
from .registry import query
from .views import APP_CTES, LINES_CTE

APPLICATION = Contract(
    name="applications",
    fields=(
        Field("event_time", "timestamp"),
        Field("priority", "categorical", ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")),
        Field("status", "categorical", ("F", "O")),
        Field("qty", "integer"),
        Field("total", "integer"),
        Field("target", "target", ("1", "2")),
    ),
    target="target",
)

REQUEST = Contract(
    name="request",
    fields=(
        Field("priority", "categorical", ("1-URGENT", "2-HIGH", "3-MEDIUM")),
        Field("status", "categorical", ("F", "O", "P")),
        Field("qty", "integer"),
        Field("total", "integer"),
    ),
)
REQUEST_RANGES = {"qty": (1, 150), "total": (1, 300000)}

RULE_ROWS = ", ".join(
    f"({i}, '{f.name}', '{f.kind}', {'NULL' if v is None else repr(v)})"
    for i, f in enumerate(APPLICATION.fields) for v in (f.allowed or (None,))
)


@query(
    "contract_rules",
    f"""WITH {APP_CTES}, rules(ordinal, field, kind, allowed) AS (VALUES {RULE_ROWS}),
v AS (SELECT 'priority' AS field, priority AS value, count(*) AS n FROM app GROUP BY priority
      UNION ALL SELECT 'status', status, count(*) FROM app GROUP BY status
      UNION ALL SELECT 'target', CAST(target AS VARCHAR), count(*) FROM app GROUP BY target)
SELECT ordinal, r.field, kind, allowed, coalesce(n, 0) AS n_rows FROM rules r LEFT JOIN v ON v.field = r.field AND v.value = r.allowed""",
)
def contract_rules(spark, sf):
    """The declared rules with the number of applications each allowed value covers."""
    counts = value_counts(views.applications(spark, sf, customer=False), ["priority", "status", "target"])
    rules = APPLICATION.rules(spark)
    seen = counts.withColumnsRenamed({"feature": "field", "value": "allowed"})
    return rules.join(seen, ["field", "allowed"], "left").select(
        "ordinal", "field", "kind", "allowed", F.coalesce("n", F.lit(0)).alias("n_rows")
    )


@query(
    "token_scan",
    f"""WITH p AS (SELECT doc_id, regexp_split_to_array(text, '{LINE_BREAK}') AS parts FROM documents),
q AS (SELECT doc_id, CASE WHEN parts[-1] = '' THEN parts[:len(parts) - 1] ELSE parts END AS parts FROM p),
l AS (SELECT doc_id, unnest(parts) AS value, unnest(range(1, len(parts) + 1)) AS line_no FROM q),
t AS (SELECT doc_id, line_no, regexp_replace(value, '^{WHITESPACE}+|{WHITESPACE}+$', '', 'g') AS s FROM l)
SELECT doc_id, line_no, s = '' AS blank, CASE WHEN s = '' THEN 0 ELSE len(regexp_split_to_array(s, '{WHITESPACE}+')) END AS n_tokens FROM t""",
)
def token_scan(spark, sf):
    docs = views.table(spark, sf, "documents")
    rows = token_lines(docs, "text", [F.col("doc_id")])
    return rows.select(
        "doc_id", "line_no", is_blank(F.col("value")).alias("blank"), token_count(F.col("value")).cast("bigint").alias("n_tokens")
    )


TOKENS = f"""
{LINES_CTE},
tok AS (SELECT app_id, regexp_split_to_array(value, ' +') AS t FROM lines),
wide AS (SELECT app_id, t[1] AS event_time, t[2] AS priority, t[3] AS status, t[4] AS qty, t[5] AS total, t[6] AS target FROM tok WHERE len(t) = 6),
viol AS (SELECT app_id AS row_id, -1 AS ordinal, '' AS field, 'column_count' AS rule, CAST(len(t) AS VARCHAR) AS value FROM tok WHERE len(t) <> 6
  UNION ALL SELECT app_id, 1, 'priority', 'membership', priority FROM wide WHERE priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
  UNION ALL SELECT app_id, 2, 'status', 'membership', status FROM wide WHERE status NOT IN ('F', 'O')
  UNION ALL SELECT app_id, 3, 'qty', 'integer', qty FROM wide WHERE NOT regexp_full_match(qty, '-?[0-9]+')
  UNION ALL SELECT app_id, 4, 'total', 'integer', total FROM wide WHERE NOT regexp_full_match(total, '-?[0-9]+')
  UNION ALL SELECT app_id, 5, 'target', 'membership', target FROM wide WHERE target NOT IN ('1', '2'))
"""


@query("contract_violations", f"WITH {APP_CTES}, {TOKENS} SELECT * FROM viol")
def contract_violations(spark, sf):
    return contracts.contract_violations(views.app_lines(spark, sf), APPLICATION, "app_id")


@query("first_violation", f"WITH {APP_CTES}, {TOKENS} SELECT * FROM viol ORDER BY row_id, ordinal LIMIT 1")
def first_violation(spark, sf):
    return contracts.first_violation(contracts.contract_violations(views.app_lines(spark, sf), APPLICATION, "app_id"))


#: No whole number of thousands, so no test table has as many rows.
DECLARED_ROWS = 1234


@query(
    "row_count_rule",
    f"WITH {APP_CTES} SELECT count(*) AS n_rows, CAST({DECLARED_ROWS} AS BIGINT) AS expected FROM app HAVING count(*) <> {DECLARED_ROWS}",
)
def row_count_rule(spark, sf):
    declared = replace(APPLICATION, expected_rows=DECLARED_ROWS)
    return contracts.row_count_violation(views.app_lines(spark, sf), declared).withColumnRenamed("rows", "n_rows")


@query(
    "dataset_summary",
    f"""WITH {APP_CTES}, {LINES_CTE},
h AS (SELECT CAST(bit_xor(CAST('0x' || substr(sha256(value), 1, 15) AS BIGINT)) AS VARCHAR) AS data_hash FROM lines)
SELECT 'applications' AS dataset_name, (SELECT count(*) FROM app) AS n_rows, 6 AS columns, data_hash, target, count(*) AS target_rows
FROM app, h GROUP BY data_hash, target""",
)
def dataset_summary(spark, sf):
    lines = materialise(views.app_lines(spark, sf), "lines")
    digest = text_fingerprint(lines, "value").first()["data_hash"]
    rows = lines.select(F.element_at(tokens(F.col("value")), -1).cast("int").alias("target"))
    return contracts.dataset_summary(rows, APPLICATION, digest).withColumnRenamed("rows", "n_rows")


@query(
    "target_binarise",
    f"WITH {APP_CTES} SELECT app_id, target - 1 AS label, target AS restored FROM app",
)
def target_binarise(spark, sf):
    label = binarise(F.col("target"))
    return views.applications(spark, sf, customer=False).select(
        "app_id", label.alias("label"), unbinarise(label).alias("restored")
    )


@query(
    "feature_select",
    f"""WITH {APP_CTES}, {TOKENS}
SELECT app_id, priority, status, CAST(qty AS BIGINT) AS qty, CAST(total AS BIGINT) AS total FROM wide
WHERE app_id NOT IN (SELECT row_id FROM viol)""",
)
def feature_select(spark, sf):
    rows = contracts.valid_rows(views.app_lines(spark, sf), APPLICATION, ["app_id"])
    return contracts.feature_frame(rows, APPLICATION, ["app_id"])


REQUEST_SQL = f"""WITH {APP_CTES}, r AS (SELECT *, CAST(floor(total) AS BIGINT) AS amount FROM app)
SELECT app_id, -1 AS ordinal, 'note' AS field, 'extra' AS rule, NULL AS value FROM r WHERE status = 'P' AND segment = 'BUILDING'
UNION ALL {{priority}}
UNION ALL SELECT app_id, 2, 'qty', 'missing', NULL FROM r WHERE qty IS NULL
UNION ALL SELECT app_id, 2, 'qty', 'range', CAST(qty AS VARCHAR) FROM r WHERE qty NOT BETWEEN 1 AND 150
UNION ALL SELECT app_id, 3, 'total', 'range', CAST(amount AS VARCHAR) FROM r WHERE amount NOT BETWEEN 1 AND 300000"""


def requests(spark, sf):
    """Requests as JSON: absent quantities leave a key out, some requests carry one too many."""
    note = F.when((F.col("status") == "P") & (F.col("segment") == "BUILDING"), "x")
    payload = F.to_json(F.struct("priority", "status", "qty", F.floor("total").alias("total"), note.alias("note")))
    return views.applications(spark, sf).select("app_id", payload.alias("payload"))


@query(
    "request_validation",
    REQUEST_SQL.format(priority="SELECT app_id, 0, 'priority', 'membership', priority FROM r WHERE priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"),
)
def request_validation(spark, sf):
    return contracts.validate_requests(requests(spark, sf), "app_id", "payload", REQUEST, REQUEST_RANGES)


@query("dropped_key", REQUEST_SQL.format(priority="SELECT app_id, 0, 'priority', 'missing', NULL FROM r"))
def dropped_key(spark, sf):
    """The same requests, each having lost its priority on the way."""
    damaged = requests(spark, sf).withColumn("payload", perturb.drop_key(F.col("payload"), "priority"))
    return contracts.validate_requests(damaged, "app_id", "payload", REQUEST, REQUEST_RANGES)
