"""DuckDB SQL for the oracle side of every registered query.

The fixtures, hash splits and solvable model cases (majority label per
feature value, closed-form log-odds, rule thresholds) are written out in
plain SQL over the pre-registered tables, so the Spark result of each query
can be compared with an independent engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from tessera.operators.experiment import SEEDS_A, SEEDS_B
from tessera.plans import mechanisms

# ---------------------------------------------------------------- fixtures

ORDERS_FLAGS = ("SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS f1, "
                "o_orderstatus AS label FROM orders")
ORDERS_BINARY = ("SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS u, "
                 "CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'notF' END AS label FROM orders")
ORDERS_DIRTY = ("SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN 1000.0::DOUBLE "
                "ELSE CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) END AS f1, o_orderstatus AS label FROM orders")
_URGENT = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
ORDERS_TWO_FLAGS = (
    f"SELECT o_orderkey, CASE WHEN {_URGENT} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS u, "
    "CAST((o_orderkey // 10) % 2 AS DOUBLE) AS w, CASE WHEN (o_orderkey * 7 + (o_orderkey // 10) * 3) % 10 < "
    f"CASE WHEN {_URGENT} THEN 8 ELSE 3 END THEN 'F' ELSE 'notF' END AS label FROM orders")
LINEITEM_RULE = ("SELECT l_discount, l_tax, CASE WHEN l_discount > 0.05 AND l_tax > 0.03 THEN 'yes' ELSE 'no' END "
                 "AS label FROM lineitem")
LINEITEM_ENCODE = "SELECT l_quantity, l_discount, l_tax, l_returnflag AS label FROM lineitem"
EVENTS_NULLS = ("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value, "
                "CAST(hour(ts) AS DOUBLE) AS hour, CAST(NULL AS DOUBLE) AS empty, 1.0::DOUBLE AS constant, "
                "event_type AS label FROM events")
EVENTS_CORRELATED = (
    "SELECT event_id, "
    "CASE WHEN event_id % 100 = 0 THEN 50.0::DOUBLE ELSE CAST(event_id % 11 AS DOUBLE) / 100.0::DOUBLE END AS a, "
    "CASE WHEN event_id % 100 = 0 THEN 1000.0::DOUBLE WHEN event_id % 1000 = 1 THEN 20.0::DOUBLE "
    "ELSE CAST(event_id % 9 AS DOUBLE) / 100.0::DOUBLE END AS b, event_type AS label FROM events")
BUCKETED_SELECT = (
    "SELECT event_id, CAST(event_id % 5 AS DOUBLE) AS c1, CAST(CAST(floor(event_id / 5) AS BIGINT) % 5 AS DOUBLE) AS c2, "
    "CAST(user_id % 5 AS DOUBLE) AS c3, CAST(minute(ts) % 5 AS DOUBLE) AS c4, event_type AS label FROM events")
DOCUMENT_QUALITY = (
    "SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS n_chars, "
    "CAST(len(string_split_regex(d.text, '\\s+')) AS DOUBLE) AS n_words, "
    "CAST(len(string_split(d.text, chr(10))) AS DOUBLE) AS n_lines, CAST(l.quality AS VARCHAR) AS label "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id")


def embedding_wide(width: int = 64) -> str:
    cols = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS feature_{i + 1}" for i in range(width))
    return f"SELECT vec_id, {cols}, CAST(label AS VARCHAR) AS label FROM embeddings"


# ---------------------------------------------------------------- hashing

def hash_unit(seed: int | str, key: str, salt: str | None = None) -> str:
    """Same value as tessera.functions.hashing.hash_unit. ``seed`` may be a
    literal or a column name."""
    seed_sql = f"'{seed}'" if isinstance(seed, int) else f"CAST({seed} AS VARCHAR)"
    salt_sql = f" || ':{salt}'" if salt is not None else ""
    text = f"CAST({key} AS VARCHAR)"
    part = f"coalesce(':' || length({text}) || ':' || {text}, ':-')"
    return (f"CAST(CAST(('0x' || substr(md5({seed_sql}{salt_sql} || {part}), 1, 8)) "
            f"AS UBIGINT) AS DOUBLE) / 4294967296.0")


def split_case(seed: int | str, key: str, fraction: float = 0.7, salt: str | None = None) -> str:
    return f"CASE WHEN {hash_unit(seed, key, salt)} < {fraction} THEN 'train' ELSE 'test' END"


def label_index(src: str, label: str = "label") -> str:
    """(label, li): frequency-descending index, ties by label."""
    return (f"SELECT {label} AS label, CAST(row_number() OVER (ORDER BY count(*) DESC, {label}) - 1 AS DOUBLE) AS li "
            f"FROM ({src}) GROUP BY {label}")


# ---------------------------------------------------------------- statistics

def seq_filter_chain(src: str, cols: Sequence[str], k: int = 3, prefix: str = "q") -> tuple[str, str]:
    """CTE chain of the sequential k-sigma filter; returns (ctes, last name)."""
    ctes = [f"{prefix}0 AS ({src})"]
    for i, c in enumerate(cols):
        prev = f"{prefix}{i}"
        ctes.append(f"{prefix}s{i + 1} AS (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {prev})")
        ctes.append(
            f"{prefix}{i + 1} AS (SELECT {prev}.* FROM {prev}, {prefix}s{i + 1} WHERE {prefix}s{i + 1}.s IS NULL "
            f"OR {prefix}s{i + 1}.s = 0 OR ({c} >= m - {k} * s AND {c} <= m + {k} * s))")
    return ",\n".join(ctes), f"{prefix}{len(cols)}"


def impute_select(src: str, cols: Sequence[str], keep_before: Sequence[str], keep_after: Sequence[str]) -> str:
    means = ", ".join(f"avg({c}) AS m_{c}" for c in cols)
    filled = ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in cols)
    pre = "".join(f"{c}, " for c in keep_before)
    post = "".join(f", {c}" for c in keep_after)
    return f"SELECT {pre}{filled}{post} FROM ({src}) AS base, (SELECT {means} FROM ({src})) AS mm"


def chi2_stat(src: str, feature: str, label: str = "label") -> str:
    """Pearson statistic and degrees of freedom of one feature vs the label."""
    return f"""(WITH cnt AS (SELECT {feature} AS v, {label} AS y, count(*)::DOUBLE AS o FROM ({src}) GROUP BY ALL),
 rt AS (SELECT v, sum(o) AS r FROM cnt GROUP BY v),
 ct AS (SELECT y, sum(o) AS c FROM cnt GROUP BY y),
 tot AS (SELECT sum(o) AS n FROM cnt)
SELECT sum(power(coalesce(cnt.o, 0) - rt.r * ct.c / tot.n, 2) / (rt.r * ct.c / tot.n)) AS statistic,
       CAST(((SELECT count(*) FROM rt) - 1) * ((SELECT count(*) FROM ct) - 1) AS BIGINT) AS dof
FROM rt CROSS JOIN ct CROSS JOIN tot LEFT JOIN cnt ON cnt.v = rt.v AND cnt.y = ct.y)"""


# ---------------------------------------------------------------- solvable models

def majority_metrics(src: str, key: str, feature: str, seeds: Sequence[int], model_seeds: Sequence[int] | None = None,
                     model: str | None = None, fraction: float = 0.7, decimals: int = 6,
                     split_seed_fixed: int | None = None) -> str:
    """Train/test accuracy and weighted F1 of a classifier that predicts the
    majority training label of each value of one feature (ties -> lower
    label index): what a tree, or an unregularised logistic regression on a
    feature whose group rates are far from 1/2, converges to.

    One row per (seed, split); with ``split_seed_fixed`` every run uses that
    split and ``seeds`` only number the runs.
    """
    runs = ", ".join(f"({i + 1}, {s})" for i, s in enumerate(seeds))
    split_seed = "seed" if split_seed_fixed is None else split_seed_fixed
    model_col = f"'{model}' AS model, " if model else ""
    return f"""WITH d AS ({src}),
idx AS ({label_index(src)}),
s AS (SELECT * FROM (VALUES {runs}) t(run, seed)),
x AS (SELECT s.run, s.seed, d.{feature} AS g, idx.li, {split_case(split_seed, 'd.' + key, fraction)} AS split
      FROM d JOIN idx ON d.label = idx.label CROSS JOIN s),
cnt AS (SELECT run, g, li, count(*) AS c FROM x WHERE split = 'train' GROUP BY ALL),
maj AS (SELECT run, g, li AS pred FROM (SELECT *, row_number() OVER (PARTITION BY run, g ORDER BY c DESC, li) AS r
        FROM cnt) WHERE r = 1),
cm AS (SELECT x.run, x.seed, x.split, x.li AS label, maj.pred AS prediction, count(*) AS n
       FROM x JOIN maj ON x.run = maj.run AND x.g = maj.g GROUP BY ALL),
e AS (SELECT *, CAST(sum(n) OVER (PARTITION BY run, split) AS DOUBLE) AS total,
             CAST(sum(n) OVER (PARTITION BY run, split, label) AS DOUBLE) AS nt,
             CAST(sum(n) OVER (PARTITION BY run, split, prediction) AS DOUBLE) AS np FROM cm)
SELECT {model_col}CAST(run AS BIGINT) AS run, CAST(seed AS BIGINT) AS seed, split, CAST(max(total) AS BIGINT) AS n,
       round(sum(CASE WHEN label = prediction THEN n ELSE 0 END) / max(total), {decimals}) AS accuracy,
       round(sum(CASE WHEN label = prediction THEN 2.0::DOUBLE * n * nt / ((nt + np) * total) ELSE 0.0 END),
             {decimals}) AS f1
FROM e GROUP BY run, seed, split"""


def majority_confusion(src: str, key: str, feature: str, seed: int, split: str, fraction: float = 0.7) -> str:
    return f"""WITH d AS ({src}),
idx AS ({label_index(src)}),
x AS (SELECT d.{feature} AS g, idx.li, {split_case(seed, 'd.' + key, fraction)} AS split
      FROM d JOIN idx ON d.label = idx.label),
cnt AS (SELECT g, li, count(*) AS c FROM x WHERE split = 'train' GROUP BY ALL),
maj AS (SELECT g, li AS pred FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY c DESC, li) AS r FROM cnt)
        WHERE r = 1)
SELECT x.li AS label, maj.pred AS prediction, count(*) AS n FROM x JOIN maj ON x.g = maj.g
WHERE x.split = '{split}' GROUP BY ALL"""


# ---------------------------------------------------------------- per-query SQL

def _profile_rows(src: str, cols: Sequence[str], k: int = 3, decimals: int = 6) -> str:
    parts = []
    for i, c in enumerate(cols):
        sd = f"stddev_samp({c})"
        ok = f"{sd} IS NOT NULL AND {sd} <> 0"
        parts.append(
            f"SELECT '{c}' AS feature, {i} AS ordinal, count({c}) AS n, count(*) - count({c}) AS n_null, "
            f"round(avg({c}), {decimals}) AS mean, round({sd}, {decimals}) AS sd, "
            f"round(CASE WHEN {ok} THEN avg({c}) - {k} * {sd} END, {decimals}) AS lo, "
            f"round(CASE WHEN {ok} THEN avg({c}) + {k} * {sd} END, {decimals}) AS hi FROM ({src})")
    return "\nUNION ALL\n".join(parts)


def _long(src: str, key: str, cols: Sequence[str], value=lambda c: c) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {key}, {i} AS pos, '{c}' AS feature, {value(c)} AS value FROM ({src})" for i, c in enumerate(cols))


def _all_at_once(src: str, cols: Sequence[str], k: int = 3) -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in cols)
    conds = " AND ".join(
        f"(s_{c} IS NULL OR s_{c} = 0 OR ({c} >= m_{c} - {k} * s_{c} AND {c} <= m_{c} + {k} * s_{c}))" for c in cols)
    return f"SELECT d.* FROM ({src}) AS d, (SELECT {stats} FROM ({src})) AS st WHERE {conds}"


EN_COLS = ["value", "hour", "empty", "constant"]
BS_COLS = ["c1", "c2", "c3", "c4"]
LE_COLS = ["l_quantity", "l_discount", "l_tax"]
EMB = embedding_wide(64)


def _csv_typed_scan() -> str:
    cols = ", ".join(f"feature_{i + 1}" for i in range(64))
    return f"SELECT {cols}, label FROM ({EMB})"


def _clean_and_assemble() -> str:
    imputed = impute_select(EVENTS_NULLS, EN_COLS, ["event_id"], ["label"])
    ctes, last = seq_filter_chain(imputed, EN_COLS)
    return f"WITH {ctes}\n" + _long(last, "event_id", EN_COLS, lambda c: f"round({c}, 6)")


def _seq_filter() -> str:
    ctes, last = seq_filter_chain(EVENTS_CORRELATED, ["a", "b"])
    return f"WITH {ctes}\nSELECT * FROM {last}"


def _prepare_dataset() -> str:
    total = " + ".join(f"feature_{i + 1}" for i in range(64))
    return (f"WITH d AS ({EMB}), idx AS ({label_index(EMB)}) "
            f"SELECT d.label, idx.li AS label_indexed, count(*) AS n, round(sum({total}), 6) AS feature_sum "
            f"FROM d JOIN idx ON d.label = idx.label GROUP BY d.label, idx.li")


def _scale_unit_std() -> str:
    sds = ", ".join(f"stddev_samp({c}) AS s_{c}" for c in LE_COLS)
    parts = [f"SELECT '{c}' AS feature, round({c} / s_{c}, 6) AS value, count(*) AS n "
             f"FROM ({LINEITEM_ENCODE}), (SELECT {sds} FROM ({LINEITEM_ENCODE})) GROUP BY ALL" for c in LE_COLS]
    return "\nUNION ALL\n".join(parts)


def _scale_train_apply_test() -> str:
    d = f"SELECT *, {split_case(42, 'event_id')} AS split FROM ({BUCKETED_SELECT})"
    sds = ", ".join(f"stddev_samp({c}) AS s_{c}" for c in BS_COLS)
    parts = [f"SELECT split, '{c}' AS feature, count(*) AS n, round(sum({c} / s_{c}), 4) AS sum_scaled "
             f"FROM ({d}), (SELECT {sds} FROM ({d}) WHERE split = 'train') GROUP BY split" for c in BS_COLS]
    return "\nUNION ALL\n".join(parts)


def _chi2_all() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {i} AS feature_index, '{c}' AS feature, round(statistic, 6) AS statistic, dof "
        f"FROM {chi2_stat(BUCKETED_SELECT, c)}" for i, c in enumerate(BS_COLS))


def _chi2_topk(k: int = 2) -> str:
    return (f"SELECT feature_index, feature FROM ({_chi2_all()}) "
            f"ORDER BY statistic DESC, feature_index LIMIT {k}")


def _chi2_binned(k: int = 8, bins: int = 16, width: int = 64) -> str:
    """Chi-square over equal-width bins, ranked by the Wilson-Hilferty score of the statistic."""
    parts = []
    for i in range(width):
        c = f"feature_{i + 1}"
        src = (f"SELECT label, CASE WHEN hi > lo THEN least(floor(({c} - lo) / ((hi - lo) / {bins})), {bins} - 1) "
               f"ELSE 0 END AS b FROM ({EMB}), (SELECT min({c}) AS lo, max({c}) AS hi FROM ({EMB}))")
        parts.append(f"SELECT {i} AS feature_index, '{c}' AS feature, statistic, dof FROM {chi2_stat(src, 'b')}")
    score = "(power(statistic / dof, 1.0 / 3.0) - (1 - 2.0 / (9.0 * dof))) / sqrt(2.0 / (9.0 * dof))"
    return (f"SELECT feature_index, feature FROM ({' UNION ALL '.join(parts)}) "
            f"ORDER BY {score} DESC, feature_index LIMIT {k}")


def _tree_fit_rule() -> str:
    def mid(c, cut):
        return (f"round(((SELECT max({c}) FROM lineitem WHERE {c} <= {cut}) + "
                f"(SELECT min({c}) FROM lineitem WHERE {c} > {cut})) / 2, 6)")
    # the first split is on the column with more rows on its pure side; the rest of the rows hold one more split
    first = ("(SELECT count(*) FILTER (l_discount <= 0.05) >= count(*) FILTER (l_tax <= 0.03) FROM lineitem)")
    rest = (f"(SELECT CASE WHEN 2 * count(*) FILTER (l_discount > 0.05 AND l_tax > 0.03) > "
            f"CASE WHEN {first} THEN count(*) FILTER (l_discount > 0.05) ELSE count(*) FILTER (l_tax > 0.03) END "
            f"THEN 1.0 ELSE 0.0 END FROM lineitem)")
    a, b = "l_discount", "l_tax"
    ta, tb = mid(a, 0.05), mid(b, 0.03)
    return f"""SELECT CAST(node AS BIGINT) AS node, CAST(depth AS BIGINT) AS depth, CAST(coalesce(l, -1) AS BIGINT) AS "left",
       CAST(coalesce(r, -1) AS BIGINT) AS "right", feature, CAST(threshold AS DOUBLE) AS threshold, CAST(prediction AS DOUBLE) AS prediction
FROM (SELECT 0 AS node, 0 AS depth, 1 AS l, 2 AS r, CASE WHEN {first} THEN '{a}' ELSE '{b}' END AS feature,
             CASE WHEN {first} THEN {ta} ELSE {tb} END AS threshold, 0.0 AS prediction
      UNION ALL SELECT 1, 1, NULL, NULL, NULL, NULL, 0.0
      UNION ALL SELECT 2, 1, 3, 4, CASE WHEN {first} THEN '{b}' ELSE '{a}' END,
             CASE WHEN {first} THEN {tb} ELSE {ta} END, {rest}
      UNION ALL SELECT 3, 2, NULL, NULL, NULL, NULL, 0.0
      UNION ALL SELECT 4, 2, NULL, NULL, NULL, NULL, 1.0)"""


def _tree_predict_rule() -> str:
    return (f"WITH d AS ({LINEITEM_RULE}), idx AS ({label_index(LINEITEM_RULE)}) "
            f"SELECT d.label, idx.li AS label_indexed, idx.li AS prediction, count(*) AS n "
            f"FROM d JOIN idx ON d.label = idx.label GROUP BY ALL")


def _group_rates(where: str = "") -> str:
    return (f"SELECT u, avg(CASE WHEN label = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS p "
            f"FROM ({ORDERS_BINARY}) {where} GROUP BY u")


def _logistic_fit() -> str:
    r = _group_rates()
    p0 = f"(SELECT p FROM ({r}) WHERE u = 0)"
    p1 = f"(SELECT p FROM ({r}) WHERE u = 1)"
    return (f"SELECT CAST(1 AS BIGINT) AS class_index, 'intercept' AS term, round(ln({p0} / (1 - {p0})), 3) AS value "
            f"UNION ALL SELECT CAST(1 AS BIGINT) AS class_index, 'u' AS term, "
            f"round(ln({p1} / (1 - {p1})) - ln({p0} / (1 - {p0})), 3) AS value")


def _lasso(regs: Sequence[float]) -> str:
    """L1 optimum on one binary feature: the fitted group rates are the observed ones moved towards each
    other by reg * sd * n / n_group, and the coefficient is 0 once they meet."""
    one = "CASE WHEN label = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    stats = (f"SELECT avg({one}) FILTER (u = 0) AS p0, avg({one}) FILTER (u = 1) AS p1, avg({one}) AS p, "
             f"count(*)::DOUBLE AS n, (count(*) FILTER (u = 0))::DOUBLE AS n0, (count(*) FILTER (u = 1))::DOUBLE AS n1, "
             f"stddev_samp(u) AS sd FROM ({ORDERS_BINARY})")
    grid = ", ".join(f"({r}::DOUBLE)" for r in regs)
    logit = lambda p: f"ln({p} / (1 - {p}))"
    return f"""WITH s AS ({stats}),
g AS (SELECT reg, s.*, sign(p1 - p0) AS sg FROM s, (VALUES {grid}) t(reg)),
m AS (SELECT reg, p, p1 - sg * reg * sd * n / n1 AS f1, p0 + sg * reg * sd * n / n0 AS f0, sg FROM g),
z AS (SELECT reg, CASE WHEN sg * (f1 - f0) > 0 THEN f1 ELSE p END AS q1, CASE WHEN sg * (f1 - f0) > 0 THEN f0 ELSE p END AS q0
      FROM m)
SELECT reg AS reg_param, 1.0::DOUBLE AS elastic_net, CAST(1 AS BIGINT) AS class_index, 'intercept' AS term,
       round({logit("q0")}, 3) AS value FROM z
UNION ALL SELECT reg, 1.0::DOUBLE, CAST(1 AS BIGINT), 'u', round({logit("q1")} - {logit("q0")}, 3) + 0.0 FROM z"""


def _cv_exact(grid: dict, folds: int = 5) -> str:
    """Grid search on one binary feature: each fold predicts the majority label of each group of its training rows
    (shrinking the two rates towards each other moves neither over 1/2)."""
    points = [(r, e) for r in grid["reg_param"] for e in grid["elastic_net"]]
    rows = ", ".join(f"({i}, {r}::DOUBLE, {e}::DOUBLE)" for i, (r, e) in enumerate(points))
    return f"""WITH d AS ({ORDERS_BINARY}), idx AS ({label_index(ORDERS_BINARY)}),
x AS (SELECT d.u AS g, idx.li, CAST(floor({hash_unit(42, 'd.o_orderkey', 'fold')} * {folds}.0) AS INTEGER) AS fold
      FROM d JOIN idx ON d.label = idx.label),
cnt AS (SELECT f.i, g, li, count(*) AS c FROM x, (SELECT unnest(range({folds})) AS i) f WHERE x.fold <> f.i GROUP BY ALL),
maj AS (SELECT i, g, li AS pred FROM (SELECT *, row_number() OVER (PARTITION BY i, g ORDER BY c DESC, li) AS r FROM cnt)
        WHERE r = 1),
cm AS (SELECT x.fold AS i, x.li AS label, maj.pred, count(*) AS n FROM x JOIN maj ON maj.i = x.fold AND maj.g = x.g GROUP BY ALL),
e AS (SELECT *, CAST(sum(n) OVER (PARTITION BY i) AS DOUBLE) AS total, CAST(sum(n) OVER (PARTITION BY i, label) AS DOUBLE) AS nt,
             CAST(sum(n) OVER (PARTITION BY i, pred) AS DOUBLE) AS np FROM cm),
s AS (SELECT i, sum(CASE WHEN label = pred THEN 2.0::DOUBLE * n * nt / ((nt + np) * total) ELSE 0.0 END) AS f1 FROM e GROUP BY i)
SELECT CAST(grid_index AS BIGINT) AS grid_index, reg_param, elastic_net, round(m, 6) AS mean_metric, round(sd, 6) AS sd_metric
FROM (SELECT avg(f1) AS m, stddev_pop(f1) AS sd FROM s), (VALUES {rows}) t(grid_index, reg_param, elastic_net)"""


def _group_probability(train_only: bool) -> str:
    where = f"WHERE {split_case(42, 'o_orderkey')} = 'train'" if train_only else ""
    r = _group_rates(where)
    return (f"SELECT d.u, CASE WHEN r.p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, "
            f"round(r.p, 4) AS p1, count(*) AS n FROM ({ORDERS_BINARY}) AS d JOIN ({r}) AS r ON d.u = r.u GROUP BY ALL")


def _metrics_one(seed: int, split: str | None, cols: str) -> str:
    m = majority_metrics(ORDERS_FLAGS, "o_orderkey", "f1", [seed])
    where = f" WHERE split = '{split}'" if split else ""
    return f"SELECT {cols} FROM ({m}){where}"


def _results_table() -> str:
    m = majority_metrics(ORDERS_FLAGS, "o_orderkey", "f1", SEEDS_A, model="decision_tree", decimals=17)
    return (f"SELECT model, run, seed, round(max(CASE WHEN split = 'train' THEN f1 END), 4) AS train_f1, "
            f"round(max(CASE WHEN split = 'test' THEN f1 END), 4) AS test_f1 FROM ({m}) GROUP BY model, run, seed")


def _run_summary() -> str:
    m = majority_metrics(ORDERS_FLAGS, "o_orderkey", "f1", SEEDS_A, model="decision_tree", decimals=17)
    parts = [f"SELECT model, split, '{x}' AS metric, round(min({x}), 6) AS min, round(max({x}), 6) AS max, "
             f"round(avg({x}), 6) AS mean, round(stddev_pop({x}), 6) AS sd FROM ({m}) GROUP BY model, split"
             for x in ("accuracy", "f1")]
    return "\nUNION ALL\n".join(parts)


def _model_comparison() -> str:
    parts = [majority_metrics(ORDERS_BINARY, "o_orderkey", "u", SEEDS_B, model=name, split_seed_fixed=42)
             for name in ("decision_tree", "logistic_regression")]
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)


def _cleaned_dirty() -> str:
    ctes, last = seq_filter_chain(impute_select(ORDERS_DIRTY, ["f1"], ["o_orderkey"], ["label"]), ["f1"])
    return f"WITH {ctes} SELECT * FROM {last}"


def _cleaned_dirty_train(seed: int) -> str:
    """Cleaning with the mean and the bounds of the seed's training rows."""
    train = f"{split_case(seed, 'o_orderkey')} = 'train'"
    return (f"WITH r AS ({ORDERS_DIRTY}), m AS (SELECT avg(f1) AS m FROM r WHERE {train}), "
            f"i AS (SELECT o_orderkey, coalesce(f1, m) AS f1, label FROM r, m), "
            f"b AS (SELECT avg(f1) AS a, stddev_samp(f1) AS s FROM i WHERE {train}) "
            f"SELECT i.* FROM i, b WHERE f1 >= a - 3 * s AND f1 <= a + 3 * s")


def _tree_train_fit(seeds: Sequence[int]) -> str:
    parts = []
    for i, seed in enumerate(seeds):
        m = majority_metrics(_cleaned_dirty_train(seed), "o_orderkey", "f1", [seed], model="decision_tree")
        # the label index comes from all rows, before cleaning
        m = m.replace(f"idx AS ({label_index(_cleaned_dirty_train(seed))})", f"idx AS ({label_index(ORDERS_DIRTY)})")
        parts.append(f"SELECT model, CAST({i + 1} AS BIGINT) AS run, seed, split, n, accuracy, f1 FROM ({m})")
    return " UNION ALL ".join(parts)


def _tree_exact() -> str:
    m = majority_metrics(_cleaned_dirty(), "o_orderkey", "f1", SEEDS_A, model="decision_tree")
    return m.replace(f"idx AS ({label_index(_cleaned_dirty())})", f"idx AS ({label_index(ORDERS_DIRTY)})")


def _two_flag_runs(seeds: Sequence[int]) -> str:
    return majority_metrics(ORDERS_TWO_FLAGS, "o_orderkey", "u", seeds, model="logistic_regression")


def _selected_exact() -> str:
    where = f"WHERE {split_case(42, 'o_orderkey')} = 'train'"
    idx = label_index(ORDERS_TWO_FLAGS)
    return (f"WITH d AS ({ORDERS_TWO_FLAGS}), idx AS ({idx}), "
            f"r AS (SELECT u, avg(CASE WHEN idx.li = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS p "
            f"FROM d JOIN idx ON d.label = idx.label {where} GROUP BY u) "
            f"SELECT d.u, CASE WHEN r.p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(r.p, 4) AS p1, "
            f"count(*) AS n, 'u' AS kept FROM d JOIN r ON d.u = r.u GROUP BY ALL")


def _tune_exact() -> str:
    m = majority_metrics(ORDERS_BINARY, "o_orderkey", "u", [42])
    return (f"SELECT split, n, accuracy, f1, 0.0001::DOUBLE AS reg_param, 1.0::DOUBLE AS elastic_net FROM ({m})")


def oracle_sql() -> dict[str, str]:
    hold = "o_orderkey"
    return {
        "csv_typed_scan": _csv_typed_scan(),
        "csv_malformed_to_null": (
            "SELECT CAST(event_id AS DOUBLE) AS feature_1, CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 "
            "THEN NULL ELSE value END AS feature_2, event_type AS label FROM events"),
        "feature_profile": _profile_rows(EVENTS_NULLS, EN_COLS),
        "null_counts": "\nUNION ALL\n".join(
            f"SELECT '{c}' AS feature, count(*) - count({c}) AS n_null FROM ({EVENTS_NULLS})" for c in EN_COLS),
        "outlier_bounds": f"SELECT feature, ordinal, mean, sd, lo, hi FROM ({_profile_rows(EVENTS_NULLS, EN_COLS)})",
        "range_filter": _all_at_once(EVENTS_CORRELATED, ["a", "b"]),
        "impute_mean": (f"SELECT event_id, round(value, 6) AS value, hour, empty, constant, label FROM "
                        f"({impute_select(EVENTS_NULLS, EN_COLS, ['event_id'], ['label'])})"),
        "outlier_filter_sequential": _seq_filter(),
        "clean_and_assemble": _clean_and_assemble(),
        "prepare_dataset": _prepare_dataset(),
        "label_frequency_index": (
            f"SELECT label, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS DOUBLE) "
            f"AS label_indexed FROM ({LINEITEM_ENCODE}) GROUP BY label"),
        "assemble_features": _long(BUCKETED_SELECT, "event_id", BS_COLS),
        "scale_unit_std": _scale_unit_std(),
        "scale_train_apply_test": _scale_train_apply_test(),
        "chi2_scores": _chi2_all(),
        "chi2_select_topk": _chi2_topk(2),
        "chi2_select_binned": _chi2_binned(),
        "random_split": ("SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_overlap, CAST(0 AS BIGINT) AS n_missing, "
                         "TRUE AS share_near_0_7 FROM orders"),
        "tree_program_exact": _tree_exact(),
        "tree_program_train_fit": _tree_train_fit(SEEDS_A[:2]),
        "baseline_program_exact": _model_comparison(),
        "tuned_program_exact": _two_flag_runs(SEEDS_B[:4]),
        "selected_program_exact": _two_flag_runs(SEEDS_A[:4]),
        "selected_logistic_exact": _selected_exact(),
        "tune_exact": _tune_exact(),
        "logistic_lasso": _lasso((0.0001, 0.001, 0.01)),
        "cv_grid_exact": _cv_exact({"reg_param": [0.0001, 0.2], "elastic_net": [1.0]}),
        "cv_best_exact": ("SELECT reg_param, elastic_net, mean_metric FROM ("
                          + _cv_exact({"reg_param": [0.0001, 0.2], "elastic_net": [1.0]}) + ") WHERE grid_index = 0"),
        "holdout_split": f"SELECT {hold}, {split_case(42, hold)} AS split FROM orders",
        "kfold_assign": f"SELECT {hold}, CAST(floor({hash_unit(42, hold, 'fold')} * 5.0) AS INTEGER) AS fold FROM orders",
        "nested_split": (f"SELECT {hold}, CASE WHEN {hash_unit(42, hold)} >= 0.7 THEN 'test' "
                         f"WHEN {hash_unit(42, hold, 'inner')} < 0.7 THEN 'train_train' ELSE 'train_test' END AS part "
                         f"FROM orders"),
        "decision_tree_fit": _tree_fit_rule(),
        "decision_tree_predict": _tree_predict_rule(),
        "decision_tree_holdout": _metrics_one(123, None, "split, n, accuracy, f1"),
        "logistic_fit": _logistic_fit(),
        "logistic_predict": _group_probability(False),
        "logistic_holdout": (f"SELECT split, n, accuracy, f1 FROM "
                             f"({majority_metrics(ORDERS_BINARY, 'o_orderkey', 'u', [42])})"),
        "scaled_logistic_fit": _group_probability(True),
        "confusion_matrix": majority_confusion(ORDERS_FLAGS, "o_orderkey", "f1", 42, "test"),
        "eval_accuracy": _metrics_one(42, "test", "n, accuracy"),
        "eval_weighted_f1": _metrics_one(42, "test", "n, f1"),
        "eval_by_split": _metrics_one(42, None, "split, n, accuracy, f1"),
        "repeated_holdout": majority_metrics(ORDERS_FLAGS, "o_orderkey", "f1", SEEDS_A, model="decision_tree"),
        "repeated_model_seed": majority_metrics(ORDERS_FLAGS, "o_orderkey", "f1", SEEDS_B, model="decision_tree",
                                                split_seed_fixed=42),
        "model_comparison": _model_comparison(),
        "results_table": _results_table(),
        "run_summary": _run_summary(),
        "results_csv_sink": _results_table(),
        **mechanisms.SQL,
    }
