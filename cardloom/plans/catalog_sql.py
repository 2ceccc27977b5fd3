"""SQL for the registered queries, written for DuckDB over views of the same tables."""

from __future__ import annotations

import math

_COLUMNS = """transaction_id, tx_datetime, customer_id, terminal_id, tx_amount,
    tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario"""

_DIRTY = f"""
base AS (
    SELECT event_id, user_id, value, ts,
           CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS sec,
           CASE WHEN value > 150 THEN 1 WHEN event_id % 37 = 0 THEN 2 WHEN user_id % 29 = 0 THEN 3 ELSE 0 END
               AS scenario
    FROM events
),
once AS (
    SELECT event_id AS transaction_id,
           CASE WHEN event_id % 71 = 0 THEN NULL ELSE ts END AS tx_datetime,
           CASE WHEN event_id % 53 = 0 THEN -1 ELSE user_id END AS customer_id,
           event_id % 1000 AS terminal_id,
           CASE WHEN event_id % 41 = 0 THEN -value WHEN event_id % 89 = 0 THEN CAST('NaN' AS DOUBLE)
                ELSE value END AS tx_amount,
           CAST(sec AS INTEGER) AS tx_time_seconds,
           CAST(floor(sec / 86400.0) AS INTEGER) AS tx_time_days,
           CAST(CASE WHEN event_id % 67 = 0 THEN 2 WHEN scenario > 0 THEN 1 ELSE 0 END AS INTEGER) AS tx_fraud,
           CAST(CASE WHEN event_id % 61 = 0 THEN 7 ELSE scenario END AS INTEGER) AS tx_fraud_scenario
    FROM base
),
dirty AS (
    SELECT {_COLUMNS} FROM once
    UNION ALL
    SELECT transaction_id, tx_datetime + INTERVAL 1 DAY, customer_id, terminal_id, tx_amount,
           tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario
    FROM once WHERE transaction_id % 10 = 0
)"""

_PARITY = """tx_datetime IS NOT NULL AND customer_id >= 0 AND terminal_id > 0 AND tx_amount >= 0
    AND tx_time_seconds >= 0 AND tx_fraud IN (0, 1) AND tx_fraud_scenario IN (0, 1, 2, 3)"""

_STRICT = """transaction_id IS NOT NULL AND tx_datetime >= TIMESTAMP '2018-01-01'
    AND tx_datetime < TIMESTAMP '2025-01-01' AND customer_id >= 0 AND terminal_id > 0
    AND tx_amount >= 0 AND NOT isnan(tx_amount) AND tx_time_seconds >= 0 AND tx_time_days >= 0
    AND tx_fraud IN (0, 1) AND tx_fraud_scenario BETWEEN 0 AND 3"""


def _deduplicated(name: str, condition: str) -> str:
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in _COLUMNS.split(",")[1:])
    return f"""
{name} AS (
    SELECT {_COLUMNS} FROM dirty WHERE {condition}
    QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {order}) = 1
)"""


_CLEAN = f"{_DIRTY},{_deduplicated('cleaned', _STRICT)}"
_CLEAN_PARITY = f"{_DIRTY},{_deduplicated('cleaned', _PARITY)}"


def _u(salt: str, *keys: str) -> str:
    text = " || ':' || ".join([f"'{salt}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _unit(salt: str, *keys: str) -> str:
    return f"({_u(salt, *keys)} / 4294967296.0::DOUBLE)"


_SCORED = f"""{_CLEAN},
scored AS (
    SELECT *, 'baseline' AS model, 1 / (1 + exp(-(tx_amount * 0.02::DOUBLE + tx_time_days * 0.01::DOUBLE
               + (-2.0)::DOUBLE))) AS score FROM cleaned
    UNION ALL
    SELECT *, 'candidate' AS model, 1 / (1 + exp(-(tx_amount * 0.03::DOUBLE + tx_time_seconds * 0.0000001::DOUBLE
               + (-4.0)::DOUBLE))) AS score FROM cleaned
),
predicted AS (SELECT *, CASE WHEN score > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM scored)"""

_WINDOWS = f"""{_SCORED},
windows AS (
    SELECT date_trunc('day', tx_datetime)::TIMESTAMP AS window_start,
           date_trunc('day', tx_datetime)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
           count(*) AS rows, count(*) FILTER (WHERE prediction = 1) AS predicted_fraud,
           count(*) FILTER (WHERE tx_fraud = 1) AS known_fraud, avg(score) AS mean_score
    FROM predicted WHERE model = 'candidate' GROUP BY 1, 2
)"""
_WINDOW_COLUMNS = """
SELECT window_start, window_end, rows, predicted_fraud, known_fraud, round(mean_score, 6) AS mean_score,
       round(predicted_fraud::DOUBLE / rows, 6) AS predicted_fraud_rate"""

_CELLS = """count(*) FILTER (WHERE {y} = 1 AND {p} = 1) AS tp,
           count(*) FILTER (WHERE {y} = 0 AND {p} = 1) AS fp,
           count(*) FILTER (WHERE {y} = 1 AND {p} = 0) AS fn,
           count(*) FILTER (WHERE {y} = 0 AND {p} = 0) AS tn"""
_TX_CELLS = _CELLS.format(y="tx_fraud", p="prediction")

_CONFUSION = f"""{_SCORED},
confusion AS (SELECT model, {_TX_CELLS} FROM predicted GROUP BY model)"""


def _metrics(digits: bool = True) -> str:
    def out(expr: str) -> str:
        return f"round({expr}, 6)" if digits else expr

    return f"""{out('(tp + tn)::DOUBLE / nullif(tp + fp + fn + tn, 0)')} AS accuracy,
       {out('tp::DOUBLE / nullif(tp + fp, 0)')} AS precision,
       {out('tp::DOUBLE / nullif(tp + fn, 0)')} AS recall,
       {out('(2 * tp)::DOUBLE / nullif(2 * tp + fp + fn, 0)')} AS f1"""


def _hard_areas(source: str, keys: str) -> str:
    """Trapezoid areas of the three-point curves of 0/1 predictions, point by point."""
    return f"""
points AS (
    SELECT {keys}, 1 AS step, tp AS c_p, fp AS c_n, tp + fn AS pos, fp + tn AS neg FROM {source}
    UNION ALL
    SELECT {keys}, 2 AS step, tp + fn AS c_p, fp + tn AS c_n, tp + fn AS pos, fp + tn AS neg FROM {source}
),
curve AS (
    SELECT *, CASE WHEN pos = 0 THEN 0 ELSE c_p::DOUBLE / pos END AS rec,
           CASE WHEN neg = 0 THEN 0 ELSE c_n::DOUBLE / neg END AS fall,
           CASE WHEN c_p + c_n > 0 THEN c_p::DOUBLE / (c_p + c_n)
                WHEN pos + neg > 0 THEN pos::DOUBLE / (pos + neg) ELSE 0 END AS prec
    FROM points
),
edges AS (
    SELECT *, coalesce(lag(rec) OVER w, 0) AS rec0, coalesce(lag(fall) OVER w, 0) AS fall0,
           coalesce(lag(prec) OVER w, prec) AS prec0
    FROM curve WINDOW w AS (PARTITION BY {keys} ORDER BY step)
),
areas AS (
    SELECT {keys}, sum((fall - fall0) * (rec + rec0) / 2)
               + (1 - max(CASE WHEN step = 2 THEN fall END)) * (max(CASE WHEN step = 2 THEN rec END) + 1) / 2
               AS area_under_roc,
           sum((rec - rec0) * (prec + prec0) / 2) AS area_under_pr
    FROM edges GROUP BY {keys}
)"""


def _poisson_case(mean: float = 1.0) -> str:
    total, parts = 0.0, []
    for k in range(14):
        total += math.exp(-mean) * mean**k / math.factorial(k)
        if 1.0 - total <= 2.0**-32:
            break
        parts.append(f"WHEN u < {total!r}::DOUBLE THEN {k}")
    return "CASE " + " ".join(parts) + f" ELSE {len(parts)} END"


_BOOTSTRAP = f"""{_SCORED},
drawn AS (SELECT *, {_unit('draws', 'model', 'transaction_id')} AS u FROM predicted),
counted AS (SELECT *, {_poisson_case()} AS k FROM drawn),
copies AS (SELECT c.*, r.copy FROM counted c JOIN range(1, 14) r(copy) ON r.copy <= c.k),
placed AS (SELECT *, CAST({_u('replicate', 'model', 'transaction_id', 'copy')} % 100 AS INTEGER) AS replicate
           FROM copies),
samples AS (SELECT model, replicate, {_TX_CELLS} FROM placed GROUP BY model, replicate)"""

_SCORES = f"""{_BOOTSTRAP},{_hard_areas('samples', 'model, replicate')},
scores AS (SELECT model, replicate, area_under_pr AS score FROM areas)"""

_SCORES_SWAPPED = f"""{_BOOTSTRAP},
turned AS (SELECT model, replicate, tp, fn AS fp, fp AS fn, tn FROM samples),
{_hard_areas('turned', 'model, replicate')}"""

_TTEST = f"""{_SCORES},
sides AS (
    SELECT avg(score) FILTER (WHERE model = 'baseline') AS m0, avg(score) FILTER (WHERE model = 'candidate') AS m1,
           var_samp(score) FILTER (WHERE model = 'baseline') AS v0,
           var_samp(score) FILTER (WHERE model = 'candidate') AS v1,
           count(score) FILTER (WHERE model = 'baseline') AS n0, count(score) FILTER (WHERE model = 'candidate') AS n1
    FROM scores
),
tested AS (
    SELECT m0, m1, n0 + n1 - 2 AS nu,
           (m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1)) AS t
    FROM sides
),
angled AS (SELECT *, atan(abs(t) / sqrt(nu)) AS theta FROM tested),
-- even degrees of freedom: P(|T| < t) = sin(theta) * sum of C(2j, j) / 4^j * cos(theta)^(2j)
inside AS (
    SELECT m0, m1, nu, t, sin(theta) * sum(exp(lgamma(j + 0.5) - lgamma(j + 1.0) - 0.5 * ln(pi()))
                                            * power(cos(theta), 2 * j)) AS covered
    FROM angled JOIN range(0, 1000) r(j) ON r.j <= (nu - 2) / 2
    GROUP BY m0, m1, nu, t, theta
),
verdict AS (
    SELECT round(m0, 6) AS mean_baseline, round(m1, 6) AS mean_candidate, round(t, 6) AS t,
           CAST(nu AS INTEGER) AS freedom, round(greatest(0, 1 - covered), 6) AS p_value,
           1 - covered < 0.01 AS differs, 1 - covered < 0.01 AND m1 > m0 AS promote
    FROM inside
)"""


def _score_areas(step: str) -> str:
    return f"""{_SCORED},
steps AS (
    SELECT model, {step} AS step, count(*) FILTER (WHERE tx_fraud = 1) AS p,
           count(*) FILTER (WHERE tx_fraud = 0) AS n
    FROM scored GROUP BY ALL
),
running AS (
    SELECT *, sum(p) OVER w AS cp, sum(n) OVER w AS cn, sum(p) OVER (PARTITION BY model) AS pos,
           sum(n) OVER (PARTITION BY model) AS neg
    FROM steps WINDOW w AS (PARTITION BY model ORDER BY step DESC ROWS UNBOUNDED PRECEDING)
),
curve AS (
    SELECT *, cp::DOUBLE / pos AS rec, cn::DOUBLE / neg AS fall, cp::DOUBLE / (cp + cn) AS prec FROM running
),
edges AS (
    SELECT *, coalesce(lag(rec) OVER w, 0) AS rec0, coalesce(lag(fall) OVER w, 0) AS fall0,
           coalesce(lag(prec) OVER w, prec) AS prec0
    FROM curve WINDOW w AS (PARTITION BY model ORDER BY step DESC)
)
SELECT model, round(sum((fall - fall0) * (rec + rec0) / 2), 6) AS area_under_roc,
       round(sum((rec - rec0) * (prec + prec0) / 2), 6) AS area_under_pr
FROM edges GROUP BY model"""


_INDEXED = """
ranks AS (
    SELECT tx_fraud_scenario AS s,
           CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(tx_fraud_scenario AS VARCHAR)) - 1 AS INTEGER) AS i
    FROM {source} GROUP BY tx_fraud_scenario
),
encoded AS (
    SELECT c.*, r.i AS scenario_index, (r.i = 0)::INTEGER::DOUBLE AS c0, (r.i = 1)::INTEGER::DOUBLE AS c1,
           (r.i = 2)::INTEGER::DOUBLE AS c2
    FROM cleaned c JOIN ranks r ON c.tx_fraud_scenario = r.s
)"""


def _scaled(column: str, source: str) -> str:
    low, high = f"(SELECT min({column}) FROM {source})", f"(SELECT max({column}) FROM {source})"
    return f"CASE WHEN {high} = {low} THEN 0.5 ELSE ({column} - {low})::DOUBLE / ({high} - {low}) END"


_TRAIN = f"train AS (SELECT * FROM encoded WHERE {_unit('split', 'transaction_id')} < 0.8)"
_TRAIN_ROWS = f"train_rows AS (SELECT * FROM cleaned WHERE {_unit('split', 'transaction_id')} < 0.8)"

_FACTOR = """factor AS (
    SELECT greatest(1, CAST(floor(count(*) FILTER (WHERE tx_fraud = 0)::DOUBLE
                                  / nullif(count(*) FILTER (WHERE tx_fraud = 1), 0)) AS BIGINT)) AS k
    FROM cleaned
)"""

_BROKEN = "(transaction_id % 97 = 0 OR transaction_id % 101 = 0 OR transaction_id % 103 = 0 OR transaction_id % 107 = 0)"

_REASONS = [
    ("transaction_id", "transaction_id IS NULL"),
    ("tx_datetime", "tx_datetime IS NULL OR tx_datetime < TIMESTAMP '2018-01-01' "
                    "OR tx_datetime >= TIMESTAMP '2025-01-01'"),
    ("customer_id", "customer_id IS NULL OR customer_id < 0"),
    ("terminal_id", "terminal_id IS NULL OR terminal_id <= 0"),
    ("tx_amount", "tx_amount IS NULL OR tx_amount < 0 OR isnan(tx_amount)"),
    ("tx_time_seconds", "tx_time_seconds IS NULL OR tx_time_seconds < 0"),
    ("tx_time_days", "tx_time_days IS NULL OR tx_time_days < 0"),
    ("tx_fraud", "tx_fraud IS NULL OR tx_fraud NOT IN (0, 1)"),
    ("tx_fraud_scenario", "tx_fraud_scenario IS NULL OR tx_fraud_scenario NOT BETWEEN 0 AND 3"),
]

_MISSING = [
    ("transaction_id", False), ("customer_id", False), ("terminal_id", False), ("tx_amount", True),
    ("tx_time_seconds", False), ("tx_time_days", False), ("tx_fraud", False), ("tx_fraud_scenario", False),
]


def _missing_sql() -> str:
    parts = []
    for name, floating in _MISSING:
        nans = f"count(*) FILTER (WHERE isnan({name}))" if floating else "CAST(0 AS BIGINT)"
        parts.append(f"SELECT '{name}' AS \"column\", {nans} AS nans, "
                     f"count(*) FILTER (WHERE {name} IS NULL) AS nulls FROM dirty")
    return f"WITH {_DIRTY} " + " UNION ALL ".join(parts)


def _reasons_sql() -> str:
    parts = [f"SELECT '{name}' AS reason, count(*) AS rows FROM dirty WHERE {broken} HAVING count(*) > 0"
             for name, broken in _REASONS]
    return f"WITH {_DIRTY} " + " UNION ALL ".join(parts)


def _rejected_sql() -> str:
    named = ", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, broken in _REASONS)
    return f"""WITH {_DIRTY}
SELECT transaction_id, tx_datetime, concat_ws(',', {named}) AS reasons FROM dirty
WHERE concat_ws(',', {named}) <> ''"""


_VIOLATIONS = [
    ("year_out_of_range", "year(tx_datetime) < 2018 OR year(tx_datetime) > 2024"),
    ("month_out_of_range", "month(tx_datetime) NOT BETWEEN 1 AND 12"),
    ("day_out_of_range", "day(tx_datetime) NOT BETWEEN 1 AND 31"),
    ("transaction_id_not_positive", "transaction_id <= 0"),
    ("customer_id_negative", "customer_id < 0"),
    ("terminal_id_negative", "terminal_id < 0"),
    ("tx_amount_not_positive", "tx_amount <= 0"),
    ("tx_time_seconds_not_positive", "tx_time_seconds <= 0"),
]


def _one_parse_sql() -> str:
    """All reports on the rows whose line is not broken, counter by counter."""
    parts = ["SELECT 'lines' AS report, 'lines' AS name, count(*) AS rows FROM dirty",
             f"SELECT 'lines', 'malformed', count(*) FROM dirty WHERE {_BROKEN}",
             "SELECT 'violations', 'rows', count(*) FROM fine", "SELECT 'cleaned', 'rows', count(*) FROM kept",
             "SELECT 'keys', 'distinct', count(DISTINCT transaction_id) FROM fine"]
    for name, floating in _MISSING:
        nans = f"count(*) FILTER (WHERE isnan({name}))" if floating else "count(*) FILTER (WHERE false)"
        parts += [f"SELECT 'nans', '{name}', {nans} FROM fine",
                  f"SELECT 'nulls', '{name}', count(*) FILTER (WHERE {name} IS NULL) FROM fine"]
    parts += [f"SELECT 'violations', '{name}', count(*) FILTER (WHERE {broken}) FROM fine" for name, broken in _VIOLATIONS]
    parts += [f"SELECT 'reasons', '{name}', count(*) FROM fine WHERE {broken} HAVING count(*) > 0" for name, broken in _REASONS]
    parts += [f"SELECT 'domains', '{name}=' || CAST({name} AS VARCHAR), count(*) FROM fine GROUP BY {name}"
              for name in ("tx_fraud", "tx_fraud_scenario")]
    fields = "CASE WHEN transaction_id % 101 = 0 THEN 5 WHEN transaction_id % 107 = 0 THEN 10 ELSE 9 END"
    parts.append(f"SELECT 'malformed', 'fields ' || CAST({fields} AS VARCHAR), count(*) FROM dirty WHERE {_BROKEN} GROUP BY 2")
    return (f"WITH {_CLEAN}, fine AS (SELECT * FROM dirty WHERE NOT {_BROKEN}), "
            f"kept AS (SELECT * FROM cleaned WHERE NOT {_BROKEN}) " + " UNION ALL ".join(parts))


def _curve_points_sql() -> str:
    return f"""WITH {_SCORED},
points AS (
    SELECT model, round(score, 6) AS score, count(*) FILTER (WHERE tx_fraud = 1) AS p, count(*) FILTER (WHERE tx_fraud = 0) AS n
    FROM scored GROUP BY ALL
),
running AS (
    SELECT *, CAST(sum(p) OVER w AS BIGINT) AS cum_p, CAST(sum(n) OVER w AS BIGINT) AS cum_n,
           sum(p) OVER (PARTITION BY model) AS all_p, sum(n) OVER (PARTITION BY model) AS all_n
    FROM points WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
)
SELECT model, score, p, n, cum_p, cum_n, round(cum_p::DOUBLE / (cum_p + cum_n), 6) AS precision,
       round(cum_p::DOUBLE / all_p, 6) AS recall, round(cum_n::DOUBLE / all_n, 6) AS fall_out FROM running"""


def _stream_rejects_sql() -> str:
    named = ", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, broken in _REASONS)
    return f"""WITH {_DIRTY},
judged AS (SELECT transaction_id, CASE WHEN transaction_id % 103 = 0 THEN 'malformed' ELSE concat_ws(',', {named}) END AS reasons
           FROM dirty)
SELECT 'rejected' AS outcome, transaction_id, reasons, count(*) AS rows FROM judged WHERE reasons <> '' GROUP BY 1, 2, 3
UNION ALL SELECT DISTINCT 'scored', transaction_id, NULL, 1 FROM judged WHERE reasons = ''
UNION ALL SELECT 'copy', transaction_id, NULL, count(*) - 1 FROM judged WHERE reasons = '' GROUP BY transaction_id HAVING count(*) > 1"""


_LABEL_CELLS = _CELLS.format(y="toxic", p="(1 - quality)")

ORACLE_SQL: dict[str, str] = {
    "clean_counts": f"""WITH {_CLEAN_PARITY}
SELECT tx_fraud_scenario, count(*) AS rows, CAST(sum(tx_fraud) AS BIGINT) AS frauds,
       CAST(sum(transaction_id) AS BIGINT) AS key_sum
FROM cleaned GROUP BY tx_fraud_scenario""",
    "csv_scan": f"WITH {_DIRTY} SELECT {_COLUMNS} FROM dirty WHERE NOT {_BROKEN}",
    "csv_rejects": f"""WITH {_DIRTY}
SELECT transaction_id,
       CASE WHEN transaction_id % 97 = 0 THEN 'Err' ELSE CAST(terminal_id AS VARCHAR) END AS terminal_text,
       CAST(CASE WHEN transaction_id % 101 = 0 THEN 5 WHEN transaction_id % 107 = 0 THEN 10 ELSE 9 END AS INTEGER)
           AS field_count
FROM dirty WHERE {_BROKEN}""",
    "parquet_roundtrip": f"WITH {_CLEAN_PARITY} SELECT {_COLUMNS} FROM cleaned",
    "partitioned_roundtrip": f"""WITH {_CLEAN}
SELECT strftime(tx_datetime, '%Y-%m-%d') AS tx_date, count(*) AS rows, CAST(sum(transaction_id) AS BIGINT) AS key_sum
FROM cleaned GROUP BY 1""",
    "message_roundtrip": f"WITH {_DIRTY} SELECT {_COLUMNS} FROM dirty",
    "clean_rules": f"WITH {_DIRTY} SELECT {_COLUMNS} FROM dirty WHERE {_PARITY}",
    "clean_rules_strict": f"WITH {_DIRTY} SELECT {_COLUMNS} FROM dirty WHERE {_STRICT}",
    "clean_rules_open_end": f"""WITH {_DIRTY}
SELECT * REPLACE (tx_datetime + INTERVAL 10 YEAR AS tx_datetime) FROM (SELECT {_COLUMNS} FROM dirty WHERE {_STRICT})""",
    "dedup_transactions": f"WITH {_CLEAN_PARITY} SELECT {_COLUMNS} FROM cleaned",
    "reject_reasons": _reasons_sql(),
    "rejected_rows": _rejected_sql(),
    "profile_nulls": _missing_sql(),
    "profile_violations": f"""WITH {_DIRTY}
SELECT count(*) AS rows,
       count(*) FILTER (WHERE year(tx_datetime) < 2018 OR year(tx_datetime) > 2024) AS year_out_of_range,
       count(*) FILTER (WHERE month(tx_datetime) NOT BETWEEN 1 AND 12) AS month_out_of_range,
       count(*) FILTER (WHERE day(tx_datetime) NOT BETWEEN 1 AND 31) AS day_out_of_range,
       count(*) FILTER (WHERE transaction_id <= 0) AS transaction_id_not_positive,
       count(*) FILTER (WHERE customer_id < 0) AS customer_id_negative,
       count(*) FILTER (WHERE terminal_id < 0) AS terminal_id_negative,
       count(*) FILTER (WHERE tx_amount <= 0) AS tx_amount_not_positive,
       count(*) FILTER (WHERE tx_time_seconds <= 0) AS tx_time_seconds_not_positive
FROM dirty""",
    "profile_domains": f"""WITH {_DIRTY}
SELECT 'tx_fraud' AS "column", tx_fraud AS value, count(*) AS rows FROM dirty GROUP BY tx_fraud
UNION ALL
SELECT 'tx_fraud_scenario' AS "column", tx_fraud_scenario AS value, count(*) AS rows FROM dirty
GROUP BY tx_fraud_scenario""",
    "profile_key_count": f"""WITH {_DIRTY}
SELECT count(*) AS distinct_keys FROM (SELECT DISTINCT transaction_id FROM dirty)""",
    "sample_rows": f"""WITH {_CLEAN}
SELECT {_COLUMNS} FROM cleaned WHERE {_unit('sample', 'transaction_id')} < 0.01""",
    "sample_with_replacement": f"""WITH {_CLEAN},
drawn AS (SELECT *, {_unit('replacement', 'transaction_id')} AS u FROM cleaned),
counted AS (SELECT *, {_poisson_case(0.01)} AS k FROM drawn)
SELECT {_COLUMNS} FROM counted JOIN range(1, 14) r(copy) ON r.copy <= k""",
    "sample_first_part": f"""WITH {_CLEAN}
SELECT {_COLUMNS} FROM cleaned WHERE {_unit('subset', 'transaction_id')} < 0.01::DOUBLE / 0.96::DOUBLE""",
    "train_test_split": f"""WITH {_CLEAN}
SELECT transaction_id, tx_fraud,
       CASE WHEN {_unit('split', 'transaction_id')} < 0.8 THEN 'train' ELSE 'test' END AS split
FROM cleaned""",
    "class_counts": f"WITH {_CLEAN} SELECT tx_fraud, count(*) AS rows FROM cleaned GROUP BY tx_fraud",
    "oversample_minority": f"""WITH {_CLEAN}, {_FACTOR}
SELECT transaction_id, tx_fraud, tx_amount, CAST(1 AS BIGINT) AS copy FROM cleaned WHERE tx_fraud = 0
UNION ALL
SELECT transaction_id, tx_fraud, tx_amount, unnest(range(1, (SELECT k FROM factor) + 1)) AS copy
FROM cleaned WHERE tx_fraud = 1""",
    "class_weights": f"""WITH {_CLEAN}, {_FACTOR}
SELECT transaction_id, tx_fraud,
       CAST(CASE WHEN tx_fraud = 1 THEN (SELECT k FROM factor) ELSE 1 END AS DOUBLE) AS class_weight
FROM cleaned""",
    "index_scenario": f"""WITH {_CLEAN}, {_INDEXED.format(source='cleaned')}
SELECT transaction_id, tx_fraud_scenario, scenario_index FROM encoded""",
    "onehot_scenario": f"""WITH {_CLEAN}, {_INDEXED.format(source='cleaned')}
SELECT transaction_id, tx_fraud_scenario, c0 AS category_0, c1 AS category_1, c2 AS category_2 FROM encoded""",
    "assemble_features": f"""WITH {_CLEAN_PARITY}, {_INDEXED.format(source='cleaned')}
SELECT transaction_id, round(tx_amount, 6) AS x0, tx_time_seconds::DOUBLE AS x1, tx_time_days::DOUBLE AS x2,
       c0 AS x3, c1 AS x4, c2 AS x5
FROM encoded WHERE tx_amount IS NOT NULL AND NOT isnan(tx_amount)""",
    "minmax_scale": f"""WITH {_CLEAN}
SELECT transaction_id, round({_scaled('tx_amount', 'cleaned')}, 6) AS x0,
       round({_scaled('tx_time_seconds', 'cleaned')}, 6) AS x1, round({_scaled('tx_time_days', 'cleaned')}, 6) AS x2
FROM cleaned""",
    "feature_pipeline": f"""WITH {_CLEAN}, {_TRAIN_ROWS}, {_INDEXED.format(source='train_rows')}, {_TRAIN}
SELECT transaction_id, """ + ", ".join(
        f"round({_scaled(c, 'train')}, 6) AS x{i}"
        for i, c in enumerate(["tx_amount", "tx_time_seconds", "tx_time_days", "c0", "c1", "c2"])
    ) + " FROM encoded",
    "model_reload_score": f"""WITH {_CLEAN}
SELECT transaction_id, tx_fraud, TRUE AS same_result FROM cleaned WHERE {_unit('split', 'transaction_id')} >= 0.8""",
    "score_transactions": f"""WITH {_SCORED}
SELECT model, transaction_id, tx_fraud, round(score, 6) AS score, prediction FROM predicted""",
    "score_missing_features": f"""WITH {_CLEAN_PARITY},
known AS (SELECT *, CASE WHEN NOT isnan(tx_amount) THEN tx_amount END AS amount FROM cleaned),
scored AS (SELECT transaction_id, tx_fraud, 1 / (1 + exp(-(amount * 0.03::DOUBLE + tx_time_seconds * 0.0000001::DOUBLE
           + (-4.0)::DOUBLE))) AS score FROM known)
SELECT transaction_id, tx_fraud, round(score, 6) AS score,
       CASE WHEN score > 0.5 THEN 1.0::DOUBLE WHEN score <= 0.5 THEN 0.0::DOUBLE END AS prediction
FROM scored""",
    "confusion_matrix": f"WITH {_CONFUSION} SELECT model, tp, fp, fn, tn FROM confusion",
    "label_confusion": f"""WITH confusion AS (SELECT 'labels' AS model, {_LABEL_CELLS} FROM labels),
{_hard_areas('confusion', 'model')}
SELECT tp, fp, fn, tn, {_metrics()}, round(area_under_roc, 6) AS area_under_roc,
       round(area_under_pr, 6) AS area_under_pr
FROM confusion JOIN areas USING (model)""",
    "classification_metrics": f"WITH {_CONFUSION} SELECT model, tp, fp, fn, tn, {_metrics()} FROM confusion",
    "classification_metrics_swapped": f"""WITH {_CONFUSION},
turned AS (SELECT model, tp, fn AS fp, fp AS fn, tn FROM confusion),
{_hard_areas('turned', 'model')},
rated AS (SELECT model, {_metrics()} FROM turned)
SELECT model, coalesce(accuracy, 0) AS acc, coalesce(f1, 0) AS f1, coalesce(precision, 0) AS precision,
       coalesce(recall, 0) AS recall, round(area_under_roc, 6) AS auc, round(area_under_pr, 6) AS arp
FROM rated JOIN areas USING (model)""",
    "hard_auc": f"""WITH {_CONFUSION}, {_hard_areas('confusion', 'model')}
SELECT model, round(area_under_roc, 6) AS area_under_roc, round(area_under_pr, 6) AS area_under_pr FROM areas""",
    "score_auc": "WITH " + _score_areas("least(floor(score * 1000), 999)"),
    "score_auc_exact": "WITH " + _score_areas("score"),
    "bootstrap_counts": f"WITH {_BOOTSTRAP} SELECT model, replicate, tp, fp, fn, tn FROM samples",
    "bootstrap_aupr": f"WITH {_SCORES} SELECT model, replicate, round(score, 6) AS score FROM scores",
    "bootstrap_aupr_swapped": f"""WITH {_SCORES_SWAPPED}
SELECT model, replicate, round(area_under_pr, 6) AS score FROM areas""",
    "score_histogram": f"""WITH {_SCORES}
SELECT model, CAST(least(floor(score * 20), 19) AS INTEGER) AS bin, count(*) AS samples FROM scores GROUP BY ALL""",
    # 1.984216951... is the two-sided 95 % limit of Student's t for 99 degrees of freedom.
    "score_interval": f"""WITH {_SCORES},
s AS (SELECT model, count(*) AS samples, avg(score) AS mean,
             1.9842169515086827 * stddev_pop(score) / sqrt(count(*)) AS half
      FROM scores GROUP BY model)
SELECT model, samples, round(mean, 6) AS mean, round(mean - half, 6) AS low, round(mean + half, 6) AS high FROM s""",
    "ab_ttest": f"WITH {_TTEST} SELECT mean_baseline, mean_candidate, t, freedom, p_value FROM verdict",
    "promotion_gate": f"""WITH {_TTEST}
SELECT mean_baseline, mean_candidate, t, freedom, p_value, differs, promote FROM verdict""",
    "metrics_long": f"""WITH {_CONFUSION},
wide AS (SELECT model AS run, tp::DOUBLE AS tp, fp::DOUBLE AS fp, fn::DOUBLE AS fn, tn::DOUBLE AS tn, {_metrics()}
         FROM confusion)
UNPIVOT wide ON tp, fp, fn, tn, accuracy, precision, recall, f1 INTO NAME metric VALUE value""",
    "kpi_error_rates": f"""WITH {_CONFUSION}
SELECT model, tp, fp, fn, tn, round(fp::DOUBLE / nullif(fp + tn, 0), 6) AS fp_rate,
       round(fn::DOUBLE / nullif(tp + fn, 0), 6) AS fn_rate,
       coalesce(fp::DOUBLE / nullif(fp + tn, 0) < 0.05 AND fn::DOUBLE / nullif(tp + fn, 0) < 0.02, FALSE)
           AS meets_limits
FROM confusion""",
    "monthly_missed_loss": f"""WITH {_SCORED}
SELECT model, strftime(tx_datetime, '%Y-%m') AS month, count(*) AS missed, round(sum(tx_amount), 6) AS loss,
       sum(tx_amount) < 500000 AS within_limit
FROM predicted WHERE tx_fraud = 1 AND prediction = 0 GROUP BY 1, 2""",
    "stream_clean": f"WITH {_CLEAN} SELECT {_COLUMNS} FROM cleaned",
    # Whole ids are broken or not, so copies of a transaction are as well.
    "stream_clean_feed": f"WITH {_CLEAN} SELECT {_COLUMNS} FROM cleaned WHERE NOT {_BROKEN}",
    "stream_rejects": _stream_rejects_sql(),
    "feed_one_parse": _one_parse_sql(),
    "profile_key_count_sketched": f"""WITH {_DIRTY}
SELECT coalesce(strftime(tx_datetime, '%Y-%m-%d'), 'none') AS scope, count(*) AS rows,
       count(DISTINCT transaction_id) AS distinct_keys, true AS near FROM dirty GROUP BY 1
UNION ALL
SELECT 'all', count(*), count(DISTINCT transaction_id), true FROM dirty""",
    "score_curve_points": _curve_points_sql(),
    "prepared_tables": f"""WITH {_SCORED}
SELECT CASE WHEN {_unit('split', 'transaction_id')} < 0.8 THEN 'train' ELSE 'test' END AS split, tx_fraud,
       count(*) AS rows, CAST(sum(transaction_id) AS BIGINT) AS key_sum, count(*) FILTER (WHERE prediction = 1) AS flagged
FROM predicted WHERE model = 'candidate' GROUP BY ALL""",
    "snapshot_rewrite": f"WITH {_CLEAN} SELECT {_COLUMNS} FROM cleaned WHERE NOT {_BROKEN}",
    "stream_score": f"""WITH {_SCORED}
SELECT transaction_id, tx_fraud, round(score, 6) AS score, prediction FROM predicted WHERE model = 'candidate'""",
    "window_metrics_all": f"WITH {_WINDOWS} {_WINDOW_COLUMNS} FROM windows",
    "stream_window_metrics": f"WITH {_WINDOWS} {_WINDOW_COLUMNS} FROM windows",
}


# ---- a fit carried to its end, by Newton's method

_FITTED_ON = ("1.0::DOUBLE", "x1", "x2", "x3")
_TERMS = ("intercept", "tx_amount", "tx_time_seconds", "tx_time_days")


def _solved(size: int, source: str) -> str:
    """Columns ``d0..`` that solve ``h * d = g`` for the symmetric matrix ``h<i><j>`` and vector ``g<i>`` of one row."""
    query, names = f"SELECT * FROM {source}", [f"{i}{j}" for i in range(size) for j in range(i, size)]
    entry = lambda i, j: f"h{min(i, j)}{max(i, j)}"
    for k in range(size - 1):  # eliminate one unknown after the other
        rows = [f"{entry(i, j)} - {entry(k, i)} * {entry(k, j)} / h{k}{k} AS {entry(i, j)}"
                for i in range(k + 1, size) for j in range(i, size)]
        right = [f"g{i} - {entry(k, i)} * g{k} / h{k}{k} AS g{i}" for i in range(k + 1, size)]
        query = f"SELECT * REPLACE ({', '.join(rows + right)}) FROM ({query})"
    for k in reversed(range(size)):
        known = "".join(f" - {entry(k, j)} * d{j}" for j in range(k + 1, size))
        query = f"SELECT *, (g{k}{known}) / h{k}{k} AS d{k} FROM ({query})"
    return query


def _newton_sums() -> str:
    """Gradient and second derivatives of the mean weighted loss, with a ridge of 0.05 on coefficients of unit deviation."""
    ridge = ["0::DOUBLE", *[f"any_value(0.05 * s{i} * s{i})" for i in (1, 2, 3)]]
    x = _FITTED_ON
    second = [f"sum(w * p * (1 - p) * {x[i]} * {x[j]}) / any_value(total){f' + {ridge[i]}' if i == j else ''} AS h{i}{j}"
              for i in range(4) for j in range(i, 4)]
    first = [f"sum(w * (y - p) * {x[i]}) / any_value(total) - {ridge[i]} * b{i} AS g{i}" for i in range(4)]
    return f"""(SELECT step, b0, b1, b2, b3, {', '.join(second + first)}
    FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2 + b3 * x3))) AS p FROM newton, points, spread WHERE step < 12)
    GROUP BY step, b0, b1, b2, b3)"""


def _points(source: str) -> str:
    """The rows of ``source`` with features scaled by the training rows."""
    scaled = [f"{_scaled(term, 'train_rows')} AS x{i}" for i, term in enumerate(_TERMS) if i]
    return f"SELECT *, tx_fraud AS y, {', '.join(scaled)} FROM {source}"


_CONVERGED = f"""{_CLEAN}, {_TRAIN_ROWS}, {_FACTOR.replace('FROM cleaned', 'FROM train_rows')},
points AS (SELECT *, CAST(CASE WHEN y = 1 THEN (SELECT k FROM factor) ELSE 1 END AS DOUBLE) AS w FROM ({_points('train_rows')})),
means AS (SELECT sum(w) AS total, sum(w * w) AS squares, {', '.join(f'sum(w * x{i}) / sum(w) AS m{i}' for i in (1, 2, 3))} FROM points),
spread AS (SELECT any_value(total) AS total, {', '.join(
    f'sqrt(sum(w * (x{i} - m{i}) * (x{i} - m{i})) / any_value(total - squares / total)) AS s{i}' for i in (1, 2, 3))} FROM points, means),
newton AS (
    SELECT 0 AS step, 0::DOUBLE AS b0, 0::DOUBLE AS b1, 0::DOUBLE AS b2, 0::DOUBLE AS b3
    UNION ALL
    SELECT step + 1, b0 + d0, b1 + d1, b2 + d2, b3 + d3 FROM ({_solved(4, _newton_sums())})
),
solution AS (SELECT * FROM newton WHERE step = 12)"""

_BY_SOLUTION = "1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2 + b3 * x3))) AS score"


def _curve_areas(steps: str, by: str) -> str:
    """Areas by ``by`` of the curve of ``steps`` ``(by, step, p, n)``, as the relations ``running``, ``curve``, ``edges``, ``areas``."""
    return f"""running AS (
    SELECT *, sum(p) OVER w AS cp, sum(n) OVER w AS cn, sum(p) OVER (PARTITION BY {by}) AS pos, sum(n) OVER (PARTITION BY {by}) AS neg
    FROM {steps} WINDOW w AS (PARTITION BY {by} ORDER BY step DESC ROWS UNBOUNDED PRECEDING)
),
curve AS (SELECT *, cp::DOUBLE / pos AS rec, cn::DOUBLE / neg AS fall, cp::DOUBLE / (cp + cn) AS prec FROM running),
edges AS (
    SELECT *, coalesce(lag(rec) OVER w, 0) AS rec0, coalesce(lag(fall) OVER w, 0) AS fall0, coalesce(lag(prec) OVER w, prec) AS prec0
    FROM curve WINDOW w AS (PARTITION BY {by} ORDER BY step DESC)
),
areas AS (SELECT {by}, sum((fall - fall0) * (rec + rec0) / 2) AS area_under_roc, sum((rec - rec0) * (prec + prec0) / 2) AS area_under_pr
    FROM edges GROUP BY {by})"""


_CLASSES = "count(*) FILTER (WHERE tx_fraud = 1) AS p, count(*) FILTER (WHERE tx_fraud = 0) AS n"
_GRID = [(amount, seconds, days) for amount in (3.0, -0.5) for seconds in (0.0, 0.25, -1.0) for days in (0.0, 0.5, -2.0)]
_GRID_ROWS = ", ".join(f"({at}, {a}::DOUBLE, {s}::DOUBLE, {d}::DOUBLE)" for at, (a, s, d) in enumerate(_GRID))
_UNSCORED = """count(*) FILTER (WHERE tx_fraud = 1 AND prediction IS NULL) AS unscored_fraud,
       count(*) FILTER (WHERE tx_fraud = 0 AND prediction IS NULL) AS unscored_normal"""
_RATES_OF_ALL = """round((tp + fp + fn + tn)::DOUBLE / nullif(tp + fp + fn + tn + unscored_fraud + unscored_normal, 0), 6) AS scored_share,
       round(tp::DOUBLE / nullif(tp + fn + unscored_fraud, 0), 6) AS recall_of_all"""

ORACLE_SQL |= {
    "train_converged": f"""WITH RECURSIVE {_CONVERGED}
SELECT term, round(coefficient, 4) AS coefficient FROM (
""" + " UNION ALL ".join(f"SELECT '{term}' AS term, b{i} AS coefficient FROM solution" for i, term in enumerate(_TERMS)) + ")",
    "train_converged_summary": f"""WITH RECURSIVE {_CONVERGED},
scored AS (SELECT y AS tx_fraud, w, {_BY_SOLUTION} FROM points, solution),
steps AS (SELECT 1 AS part, score AS step, {_CLASSES} FROM scored GROUP BY score),
{_curve_areas('steps', 'part')}
SELECT 'converged' AS run, round((SELECT sum(w) FILTER (WHERE (score > 0.5) = (tx_fraud = 1)) / sum(w) FROM scored), 5) AS accuracy,
       round(area_under_roc, 5) AS area_under_roc, round(area_under_pr, 4) AS area_under_pr, TRUE AS summary_agrees
FROM areas""",
    "train_converged_holdout": f"""WITH RECURSIVE {_CONVERGED},
test AS (SELECT * FROM cleaned WHERE {_unit('split', 'transaction_id')} >= 0.8),
judged AS (SELECT *, CASE WHEN score > 0.5 THEN 1 WHEN score <= 0.5 THEN 0 END AS prediction
    FROM (SELECT *, {_BY_SOLUTION} FROM ({_points('test')}), solution)),
counts AS (SELECT tx_time_days, {_TX_CELLS}, {_UNSCORED} FROM judged GROUP BY tx_time_days)
SELECT *, {_metrics()}, {_RATES_OF_ALL} FROM counts""",
    "stream_score_converged": f"""WITH RECURSIVE {_CONVERGED}
SELECT tx_time_days, count(*) AS rows, round(avg(score), 4) AS mean_score
FROM (SELECT tx_time_days, {_BY_SOLUTION} FROM ({_points('cleaned')}), solution) GROUP BY tx_time_days""",
    "grid_areas_fixed": f"""WITH {_CLEAN},
points AS (SELECT tx_fraud, {', '.join(f"{_scaled(term, 'cleaned')} AS x{i}" for i, term in enumerate(_TERMS) if i)} FROM cleaned),
grid(candidate, a, s, d) AS (VALUES {_GRID_ROWS}),
steps AS (
    SELECT candidate, least(CAST(floor((a * x1 + s * x2 + d * x3 - (least(a, 0) + least(s, 0) + least(d, 0)))
           / (abs(a) + abs(s) + abs(d)) * 16384) AS INTEGER), 16383) AS step, {_CLASSES}
    FROM points, grid GROUP BY ALL
),
{_curve_areas('steps', 'candidate')}
SELECT candidate, round(area_under_roc, 6) AS area_under_roc, round(area_under_pr, 6) AS area_under_pr FROM areas""",
    "tune_grid": f"""WITH {_CLEAN}, {_TRAIN_ROWS},
sides AS (SELECT {_unit('tune-7', 'transaction_id')} < 0.75 AS fitted, tx_fraud FROM train_rows)
SELECT reg_param, fit_intercept, elastic_net, count(*) FILTER (WHERE fitted) AS fit_rows,
       count(*) FILTER (WHERE NOT fitted) AS validation_rows, count(*) FILTER (WHERE NOT fitted AND tx_fraud = 1) AS validation_fraud,
       TRUE AS intercept_kept, TRUE AS best_is_largest, CAST(1 AS BIGINT) AS chosen
FROM sides, (VALUES (0.05::DOUBLE), (0.1::DOUBLE), (0.5::DOUBLE)) AS r(reg_param), (VALUES (FALSE), (TRUE)) AS f(fit_intercept),
     (VALUES (0.0::DOUBLE), (0.5::DOUBLE), (1.0::DOUBLE)) AS e(elastic_net)
GROUP BY reg_param, fit_intercept, elastic_net""",
    "confusion_unscored": f"""WITH {_CLEAN_PARITY},
scored AS (SELECT tx_fraud, 1 / (1 + exp(-(CASE WHEN NOT isnan(tx_amount) THEN tx_amount END * 0.03::DOUBLE
    + tx_time_seconds * 0.0000001::DOUBLE + (-4.0)::DOUBLE))) AS score FROM cleaned),
judged AS (SELECT *, CASE WHEN score > 0.5 THEN 1 WHEN score <= 0.5 THEN 0 END AS prediction FROM scored),
counts AS (SELECT {_TX_CELLS}, {_UNSCORED} FROM judged),
rates AS (SELECT *, fp::DOUBLE / nullif(fp + tn, 0) AS of_normal, (fn + unscored_fraud)::DOUBLE / nullif(tp + fn + unscored_fraud, 0) AS of_fraud FROM counts)
SELECT * EXCLUDE (of_normal, of_fraud), {_metrics()}, {_RATES_OF_ALL}, round(of_normal, 6) AS fp_rate, round(of_fraud, 6) AS fn_rate,
       coalesce(of_normal < 0.05 AND of_fraud < 0.02, FALSE) AS meets_limits
FROM rates""",
    "bootstrap_by_cell_bounds": f"""WITH {_CONFUSION}
SELECT model, cell, rows, CAST(100 AS BIGINT) AS samples, TRUE AS within_bounds
FROM (UNPIVOT (SELECT model, tp, fp, fn, tn FROM confusion) ON tp, fp, fn, tn INTO NAME cell VALUE rows)""",
}
