"""Deliberate damage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contract as contracts
from ..operators import drift, perturb
from ..session import materialise
from . import views
from .contract_queries import APPLICATION, TOKENS
from .psi_sql import psi_ctes
from .registry import query, rounded
from .views import APP_CTES, APP_SIDES, LINES_CTE, NUMERIC

PICK = """
h AS (SELECT *, CAST('0x' || substr(md5('42:' || CAST(app_id AS VARCHAR)), 1, 13) AS BIGINT) AS hh FROM app),
pick AS (SELECT *, row_number() OVER (ORDER BY hh, app_id) <= CAST(floor(count(*) OVER () * {fraction}::DOUBLE) AS BIGINT) AS picked FROM h)
"""


def _labelled(spark, sf):
    apps = views.applications(spark, sf, customer=False)
    return materialise(apps.select("app_id", (F.col("target") - 1).alias("label")), "labels")


@query(
    "label_noise_flip",
    f"WITH {APP_CTES}, {PICK.format(fraction=0.05)} SELECT app_id, target - 1 AS label, CASE WHEN picked THEN 2 - target ELSE target - 1 END AS noisy_label FROM pick",
)
def label_noise_flip(spark, sf):
    return perturb.inject_label_noise(_labelled(spark, sf), "app_id", "label")


@query(
    "label_noise_majority",
    f"""WITH {APP_CTES}, {PICK.format(fraction=0.1)}, m AS (SELECT CASE WHEN avg(target - 1) > 0.5 THEN 1 ELSE 0 END AS major FROM app)
SELECT app_id, target - 1 AS label, CASE WHEN picked THEN major ELSE target - 1 END AS noisy_label FROM pick, m""",
)
def label_noise_majority(spark, sf):
    return perturb.inject_label_noise(_labelled(spark, sf), "app_id", "label", 0.1, "majority")


@query(
    "label_noise_metadata",
    f"""WITH {APP_CTES}, {PICK.format(fraction=0.05)}, n AS (SELECT target - 1 AS label, CASE WHEN picked THEN 2 - target ELSE target - 1 END AS noisy FROM pick)
SELECT 0.05::DOUBLE AS noise_fraction_requested, round(avg(CASE WHEN label <> noisy THEN 1.0::DOUBLE ELSE 0 END), 6) AS noise_fraction_actual, count(*) AS total_labels,
count(*) FILTER (WHERE label <> noisy) AS num_flipped, count(*) FILTER (WHERE label = 0 AND noisy = 1) AS num_0_to_1_flips,
count(*) FILTER (WHERE label = 1 AND noisy = 0) AS num_1_to_0_flips, 'flip' AS noise_type, 42 AS seed FROM n""",
)
def label_noise_metadata(spark, sf):
    return rounded(perturb.noise_metadata(perturb.inject_label_noise(_labelled(spark, sf), "app_id", "label"), "label"))


@query(
    "missing_labels",
    f"WITH {APP_CTES}, {PICK.format(fraction=0.1)} SELECT app_id, CASE WHEN NOT picked THEN target - 1 END AS late_label FROM pick",
)
def missing_labels(spark, sf):
    return perturb.inject_missing_labels(_labelled(spark, sf), "app_id", "label").select("app_id", "late_label")


@query(
    "missing_label_metadata",
    f"""WITH {APP_CTES}, {PICK.format(fraction=0.1)} SELECT count(*) AS total_labels, count(*) FILTER (WHERE picked) AS missing_labels,
count(*) FILTER (WHERE NOT picked) AS available_labels, 0.1::DOUBLE AS missing_fraction, 30 AS simulated_delay_days FROM pick""",
)
def missing_label_metadata(spark, sf):
    return perturb.missing_label_metadata(perturb.inject_missing_labels(_labelled(spark, sf), "app_id", "label"))


@query(
    "schema_mismatch",
    f"""WITH {APP_CTES}, {LINES_CTE}
SELECT app_id AS row_id, -1 AS ordinal, '' AS field, 'column_count' AS rule, CAST(len(regexp_split_to_array(value || ' X', ' +')) AS VARCHAR) AS value
FROM lines WHERE len(regexp_split_to_array(value || ' X', ' +')) <> 6""",
)
def schema_mismatch(spark, sf):
    """Every row gets one token too many and is reported."""
    lines = views.app_lines(spark, sf).withColumn("value", perturb.append_token(F.col("value")))
    return contracts.contract_violations(lines, APPLICATION, "app_id")


@query(
    "shift_contract_tokens",
    f"""WITH {APP_CTES}, {LINES_CTE}, tok AS (SELECT app_id, value, regexp_split_to_array(value, ' +') AS t FROM lines),
s AS (SELECT app_id, value, len(t) AS n, list_transform(t, lambda x, i: CASE WHEN i IN (4, 5) AND regexp_full_match(x, '-?[0-9]+')
      THEN CAST(CAST(x AS BIGINT) + 2 AS VARCHAR) ELSE x END) AS u FROM (SELECT app_id, value, t FROM tok))
SELECT app_id, array_to_string(u, ' ') AS value FROM s""",
)
def shift_contract_tokens(spark, sf):
    lines = views.app_lines(spark, sf)
    return lines.select("app_id", perturb.shift_contract_tokens(F.col("value"), APPLICATION).alias("value"))


@query(
    "shift_tokens",
    f"""WITH {APP_CTES}, {LINES_CTE}, tok AS (SELECT app_id, regexp_split_to_array(value, ' +') AS t, len(regexp_split_to_array(value, ' +')) AS n FROM lines)
SELECT app_id, array_to_string(list_append(list_transform(t[:n - 1], lambda x: CASE WHEN regexp_full_match(x, '[0-9]+')
       THEN CAST(CAST(x AS BIGINT) + 2 AS VARCHAR) ELSE x END), t[n]), ' ') AS value FROM tok""",
)
def shift_tokens(spark, sf):
    """Every numeric token of the rows but the last moves by 2."""
    lines = views.app_lines(spark, sf)
    return lines.select("app_id", perturb.shift_tokens(F.col("value")).alias("value"))


SHIFTED = """
moved AS (SELECT app_id, n_items + 2 AS n_items, qty + 2 AS qty, total + 2.0::DOUBLE AS total, balance + 2.0::DOUBLE AS balance FROM cur)
"""


@query(
    "shift_numeric_psi",
    f"""WITH {APP_SIDES}, {SHIFTED}, {psi_ctes(NUMERIC)}, {psi_ctes(NUMERIC, cur='moved', prefix='m_')}
SELECT a.feature, round(a.psi, 6) AS psi_before, round(b.psi, 6) AS psi_after FROM psi a JOIN m_psi b ON a.feature = b.feature""",
)
def shift_numeric_psi(spark, sf):
    ref, cur = views.app_sides(spark, sf)
    features = drift.Features(NUMERIC)
    edges = drift.numeric_edges(ref, NUMERIC)
    before = drift.psi(ref, cur, features, edges=edges).withColumnRenamed("psi", "psi_before")
    after = drift.psi(ref, perturb.shift_columns(cur, NUMERIC), features, edges=edges).withColumnRenamed("psi", "psi_after")
    return rounded(before.join(after, "feature"))


DAMAGED = TOKENS.replace(
    "tok AS (SELECT app_id, regexp_split_to_array(value, ' +') AS t FROM lines)",
    """split AS (SELECT app_id, regexp_split_to_array(value, ' +') AS t FROM lines),
tok AS (SELECT app_id, list_transform(t, lambda x, i: CASE WHEN i = 2 AND app_id < 5000 THEN 'A999' ELSE x END) AS t FROM split)""",
)


@query("bad_category", f"WITH {APP_CTES}, {DAMAGED} SELECT * FROM viol")
def bad_category(spark, sf):
    """Unknown categories in the first rows by key, and all violations of the damaged rows."""
    lines = views.app_lines(spark, sf)
    bad = lines.select("app_id", perturb.bad_category_token(F.col("value"), F.col("app_id"), 5000).alias("value"))
    return contracts.contract_violations(bad, APPLICATION, "app_id")
