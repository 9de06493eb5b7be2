"""The same questions in plain SQL, for comparison on the same Parquet tables."""

from __future__ import annotations

import itertools
import random

from ..operators.baseline import STRATEGIES
from .queries import KEYWORDS, LINE_NUMBERS, RANDOM_GRID, SEED, TIED_NUMBERS, WIDE_COLUMNS
from .tables import DIRTY_ORDERS

DIRTY = f"dirty AS (SELECT {DIRTY_ORDERS} FROM orders)"
TOKENS = "('', 'na', 'NA', 'null', 'NULL')"
DIRTY_COLUMNS = [
    ("o_orderkey", "numeric", "bigint"), ("o_custkey", "numeric", "bigint"), ("o_orderpriority", "string", "string"),
    ("o_orderdate", "temporal", "timestamp_ntz"), ("o_totalprice", "numeric", "double"),
    ("o_orderstatus", "string", "string"), ("sparse_col", "numeric", "double"), ("is_even", "boolean", "boolean"),
    ("floor_txt", "string", "string"), ("empty_col", "numeric", "double"), ("const_col", "string", "string"),
]
PART_COLUMNS = [("p_name", "string", ""), ("p_brand", "string", ""), ("p_type", "string", ""), ("p_size", "numeric", ""),
                ("p_retailprice", "numeric", "")]


def _profile(source: str, cols, limit: int, offset: int = 0) -> str:
    lines = []
    for i, (c, kind, _) in enumerate(cols):
        boolean = {"boolean": "true", "numeric": f"count(*) FILTER ({c} NOT IN (0, 1)) = 0"}.get(kind, f"count({c}) = 0")
        tokens = f" OR count(*) FILTER ({c} IN {TOKENS}) > 0" if kind == "string" else ""
        crowded = f"count(DISTINCT {c}) > {limit}" if kind == "string" else "false"
        lines.append(
            f"SELECT CAST({i + offset} AS INTEGER) AS position, '{c}' AS \"column\", '{kind}' AS kind, count(*) AS n_rows, "
            f"count({c}) AS non_null, round(100.0::DOUBLE * count({c}) / count(*), 6) AS fill_rate, "
            f"count({c}) = 0 AS is_empty, "
            f"count(DISTINCT {c}) + (count({c}) < count(*))::INT <= 1 AS is_constant, {boolean} AS is_boolean, "
            f"{str(kind == 'string').lower()} AS is_string, {str(kind == 'numeric').lower()} AS is_numeric, "
            f"(count(*) - count({c}))::DOUBLE / count(*) > 0.5 AS is_sparse, "
            f"(count({c}) < count(*){tokens}) AS is_missing_like, {crowded} AS is_high_cardinality FROM {source}")
    return " UNION ALL ".join(lines)


def _column_lists() -> str:
    flags = {"empty": "is_empty", "unique_value": "is_constant", "string": "is_string", "boolean": "is_boolean",
             "numeric": "is_numeric", "high_na": "is_sparse", "high_cardinality": "is_high_cardinality",
             "missing_like": "is_missing_like"}
    picks = " UNION ALL ".join(f"SELECT '{name}' AS list, \"column\" FROM p WHERE {flag}" for name, flag in flags.items())
    return f"WITH {DIRTY}, p AS ({_profile('dirty', DIRTY_COLUMNS, 6)}) {picks}"


def _per_column(measure: str, alias: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\"{extra.format(i=i, dtype=d)}, {measure.format(c=c)} AS {alias} FROM dirty"
        for i, (c, _, d) in enumerate(DIRTY_COLUMNS))


def _describe(source: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"round(min({c})::DOUBLE, 6) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q25, "
        f"round(quantile_cont({c}::DOUBLE, 0.5), 6) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q75, "
        f"round(max({c})::DOUBLE, 6) AS max FROM {source}" for c in cols)


def _duplicates(order: str, keep: str) -> str:
    return (f"SELECT doc_id, lang, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id {order}) r, "
            f"count(*) OVER (PARTITION BY text) n FROM documents) WHERE {keep}")


def _matrix(source: str, cols, only_lower: bool = False) -> str:
    cells = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if only_lower and i <= j:
                continue
            if i == j:
                value = f"CASE WHEN min({a}) < max({a}) THEN 1.0::DOUBLE END"
            else:
                value = (f"CASE WHEN var_pop({a}) FILTER ({b} IS NOT NULL) > 0 AND var_pop({b}) FILTER ({a} IS NOT NULL) > 0 "
                         f"THEN round(corr({a}, {b}), 6) END")
            cells.append(f"SELECT {i}::INTEGER AS row_pos, {j}::INTEGER AS col_pos, '{a}' AS \"row\", '{b}' AS col, {value} AS corr FROM {source}")
    return " UNION ALL ".join(cells)


def _target_corr(limit: str, extra: str = "") -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(abs(corr({c}, (l_returnflag = 'R')::INT)), 6) AS abs_corr, "
        f"abs(corr({c}, (l_returnflag = 'R')::INT)) AS exact FROM lineitem" for c in LINE_NUMBERS)
    return f"SELECT feature, abs_corr{extra} FROM ({rows}) ORDER BY exact DESC NULLS LAST, feature{limit}"


def _spearman(source: str, pairs) -> str:
    out = []
    for a, b in pairs:
        out.append(
            f"SELECT '{a}' AS \"row\", '{b}' AS col, round(corr(ra, rb), 6) AS corr FROM ("
            f"SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0::DOUBLE AS ra, "
            f"rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0::DOUBLE AS rb "
            f"FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")
    return " UNION ALL ".join(out)


def _kendall(pairs, source: str = "lineitem") -> str:
    out = []
    for a, b in pairs:
        out.append(
            f"SELECT '{a}' AS \"row\", '{b}' AS col, (SELECT round(sum(p.n::DOUBLE * q.n * sign(p.x - q.x) * sign(p.y - q.y)) / "
            f"(sqrt(sum(CASE WHEN p.x <> q.x THEN p.n::DOUBLE * q.n ELSE 0 END)) * "
            f"sqrt(sum(CASE WHEN p.y <> q.y THEN p.n::DOUBLE * q.n ELSE 0 END))), 6) FROM c p, c q) AS corr "
            f"FROM (SELECT 1)")
        out[-1] = (f"(WITH c AS (SELECT {a}::DOUBLE AS x, {b}::DOUBLE AS y, count(*) AS n FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2) {out[-1]})")
    return " UNION ALL ".join(out)


def _bins(source: str, c: str, with_edges: bool) -> str:
    guess = "least(floor((v - lo) / ((hi - lo) / 40)), 39)"
    edges = (", round(lo + bin * ((hi - lo) / 40), 6) AS bin_start, "
             "round(CASE WHEN bin = 39 THEN hi ELSE lo + (bin + 1) * ((hi - lo) / 40) END, 6) AS bin_end") if with_edges else ""
    group = "bin, lo, hi" if with_edges else "bin"
    return (f"SELECT '{c}' AS \"column\", bin{edges}, count(*) AS n FROM ("
            f"SELECT lo, hi, CAST(g - (v < lo + g * ((hi - lo) / 40))::INT "
            f"+ (v >= lo + (g + 1) * ((hi - lo) / 40) AND g < 39)::INT AS INTEGER) AS bin FROM ("
            f"SELECT v, lo, hi, {guess} AS g FROM (SELECT {c}::DOUBLE AS v, min({c}::DOUBLE) OVER () AS lo, "
            f"max({c}::DOUBLE) OVER () AS hi FROM {source} WHERE {c} IS NOT NULL))) GROUP BY {group}")


def _value_counts(source: str, cols, n: int) -> str:
    return " UNION ALL ".join(
        f"(SELECT '{c}' AS \"column\", value, n, r AS rank FROM (SELECT value, count(*) AS n, "
        f"row_number() OVER (ORDER BY count(*) DESC, value NULLS FIRST) AS r FROM "
        f"(SELECT {label} AS value FROM {source}) GROUP BY value) WHERE r <= {n})" for c, label in cols)


def _digest(*parts: str) -> str:
    """md5 of every part as length:text."""
    return "md5(concat(" + ", ".join(f"length({p}::VARCHAR), ':', {p}" for p in parts) + "))"


def _split(source: str, key: str, stratum: str | None, name: str = "split") -> str:
    """CTEs giving every row its side: smallest digests first, class sizes by largest remainder."""
    s = stratum or "0"
    return f"""
  {name}_h AS (SELECT *, {s} AS stratum_, {_digest(key, f"'{SEED}'")} AS digest_ FROM {source}),
  {name}_c AS (SELECT stratum_, count(*) AS n FROM {name}_h GROUP BY 1),
  {name}_t AS (SELECT sum(n) AS total, sum(n) - ceil(sum(n) * 0.2::DOUBLE) AS n_train FROM {name}_c),
  {name}_e AS (SELECT stratum_, n, n_train, n_train::DOUBLE * n / total AS x FROM {name}_c, {name}_t),
  {name}_r AS (SELECT *, n_train - sum(floor(x)) OVER () AS spare,
               row_number() OVER (ORDER BY x - floor(x) DESC, stratum_::VARCHAR) AS place FROM {name}_e),
  {name}_n AS (SELECT stratum_, n - floor(x) - (place <= spare)::INT AS n_test FROM {name}_r),
  {name} AS (SELECT h.* EXCLUDE (stratum_, digest_), CASE WHEN row_number() OVER (PARTITION BY h.stratum_ ORDER BY h.digest_) <= n.n_test
             THEN 'test' ELSE 'train' END AS split FROM {name}_h h JOIN {name}_n n ON h.stratum_ = n.stratum_)"""


def _folds(source: str, key: str, stratum: str, k: int) -> str:
    """Smallest digests first; a class's surplus rows go to the folds after those the classes before it served."""
    # the fold is the number of folds that end at or before the row
    ends = [f"{i} * (n // {k}) + list_sum(list_transform(range({i}), lambda j: ((j + {k} - before_ % {k}) % {k} < n % {k})::INT))"
            for i in range(1, k)]
    fold = " + ".join(f"(r >= {end})::INT" for end in ends)
    return f"""SELECT * EXCLUDE (before_), CAST({fold} AS INTEGER) AS fold FROM (
      SELECT s.*, c.n, c.before_, row_number() OVER (PARTITION BY s.{stratum} ORDER BY {_digest(f's.{key}', f"'{SEED}'")}) - 1 AS r
      FROM {source} s JOIN (SELECT {stratum} AS g, count(*) AS n, (sum(count(*)) OVER (ORDER BY {stratum}::VARCHAR) - count(*))::BIGINT AS before_
      FROM {source} GROUP BY 1) c ON s.{stratum} = c.g)"""


def _scaled(c: str) -> str:
    q = f"(quantile_cont({c}::DOUBLE, {{}}) OVER ())"
    return (f"round(({c} - {q.format(0.5)}) / CASE WHEN {q.format(0.75)} = {q.format(0.25)} THEN 1 "
            f"ELSE {q.format(0.75)} - {q.format(0.25)} END, 6) AS \"num__{c}\"")


def _unit(*parts: str) -> str:
    return f"CAST('0x' || substr({_digest(*parts)}, 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE"


DRAW = _unit("doc_id", f"'{SEED}'")
PRIORITIES = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

REPORT = """
  k AS (SELECT unnest([0, 1]) AS label),
  m AS (SELECT label, (SELECT count(*) FROM g WHERE y = label AND p = label) AS hits,
        (SELECT count(*) FROM g WHERE y = label) AS support, (SELECT count(*) FROM g WHERE p = label) AS chosen FROM k),
  s AS (SELECT label, support, hits, coalesce(hits::DOUBLE / nullif(chosen, 0), 0) AS precision,
        coalesce(hits::DOUBLE / nullif(support, 0), 0) AS recall,
        coalesce(2.0::DOUBLE * hits / nullif(support + chosen, 0), 0) AS f1_score FROM m),
  lines AS (
  SELECT label::INTEGER AS position, label::VARCHAR AS label, precision, recall, f1_score, support FROM s
  UNION ALL SELECT 2, 'accuracy', NULL, NULL, sum(hits)::DOUBLE / sum(support), sum(support)::BIGINT FROM s
  UNION ALL SELECT 3, 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support)::BIGINT FROM s
  UNION ALL SELECT 4, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
            sum(f1_score * support) / sum(support), sum(support)::BIGINT FROM s)
  SELECT position, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
         support FROM lines"""


def _clean() -> str:
    """Statistics from the train side, in the order the steps run."""
    return f"""WITH {DIRTY}, {_split('dirty', 'o_orderkey', 'o_orderpriority', 'd')},
  mode AS (SELECT is_even AS m FROM d WHERE split = 'train' AND is_even IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
  f AS (SELECT *, CASE WHEN floor_txt = 'bajo' THEN 0 ELSE try_cast(floor_txt AS DOUBLE) END AS fl FROM d),
  med AS (SELECT median(fl) AS mf, median(o_totalprice) AS mp FROM f WHERE split = 'train'),
  g AS (SELECT f.*, coalesce(o_totalprice, mp) AS price, mf FROM f, med),
  v AS (SELECT *, CASE WHEN price >= 50000 THEN price END AS valid FROM g),
  med2 AS (SELECT median(valid) AS mv FROM v WHERE split = 'train')
  SELECT o_orderkey, split, coalesce(is_even, (SELECT m FROM mode)) AS is_even, coalesce(fl, mf) AS floor_txt,
         coalesce(valid, mv) AS o_totalprice FROM v, med2"""


def _searched(candidates, k: int) -> str:
    """Stratified folds of the train side; each (strategy, seed) trained on the others and scored on the fold."""
    def guess(strategy: str, seed: int) -> str:
        draw = _unit("doc_id", f"'{seed}'")
        return {
            "stratified": f"CASE WHEN {draw} < (SELECT sum(n) FILTER (y = 0) / sum(n) FROM b WHERE b.f = t.f) THEN 0 ELSE 1 END",
            "uniform": f"CASE WHEN {draw} < 0.5 THEN 0 ELSE 1 END",
        }.get(strategy, "(SELECT y FROM b WHERE b.f = t.f ORDER BY n DESC, y LIMIT 1)")

    scores = " UNION ALL ".join(
        f"SELECT {i} AS candidate, '{strategy}' AS strategy, {seed} AS seed, f, avg((y = {guess(strategy, seed)})::INT::DOUBLE) AS score "
        f"FROM (SELECT doc_id, quality AS y, fold AS f FROM folds) t GROUP BY f" for i, (strategy, seed) in enumerate(candidates))
    return f"""WITH {_split('labels', 'doc_id', 'quality')},
  train AS (SELECT * EXCLUDE (split) FROM split WHERE split = 'train'),
  folds AS ({_folds('train', 'doc_id', 'quality', k)}),
  b AS (SELECT k.f, quality AS y, count(*) AS n FROM folds, (SELECT unnest(range({k})) AS f) k WHERE fold <> k.f GROUP BY 1, 2),
  scores AS ({scores}),
  means AS (SELECT candidate, strategy, seed, avg(score) AS m, stddev_pop(score) AS d FROM scores GROUP BY ALL),
  ranked AS (SELECT candidate::INTEGER AS candidate, strategy, seed::INTEGER AS seed, round(m, 6) AS mean_score, round(d, 6) AS std_score,
    CAST(1 + (SELECT count(*) FROM means o WHERE round(o.m, 12) > round(means.m, 12)) AS INTEGER) AS rank FROM means)"""


RANDOM_CANDIDATES = random.Random(SEED).sample(list(itertools.product(*RANDOM_GRID.values())), 4)


def _study() -> str:
    return f"""WITH {_split('orders', 'o_orderkey', 'o_orderstatus')},
  t AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS y FROM split WHERE split = 'train')
  SELECT 'o_custkey' AS feature, round(abs(corr(o_custkey, y)), 6) AS abs_corr, (SELECT count(*) - count(DISTINCT
         (o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)) FROM orders)::INTEGER AS n_duplicates FROM t
  UNION ALL SELECT 'o_totalprice', round(abs(corr(o_totalprice, y)), 6), (SELECT count(*) - count(DISTINCT
         (o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)) FROM orders)::INTEGER FROM t"""


def _slots() -> str:
    flags = [f"(coalesce(o_orderstatus, '~') = '{v}')::INT" for v in ("F", "O", "P", "na", "~")]
    flags += ["(coalesce(is_even::INT, 2) = 1)::INT", "(is_even IS NULL)::INT"]
    scaled = _scaled("sparse_col").split(" AS ")[0].replace("round(", "(", 1).replace(", 6)", ")")
    parts = [f"SELECT 0::INTEGER AS slot, round(sum(v), 3) AS total FROM (SELECT {scaled} AS v FROM dirty)"]
    parts += [f"SELECT {i}::INTEGER, round(sum({f})::DOUBLE, 3) FROM dirty" for i, f in enumerate(flags, 1)]
    return f"WITH {DIRTY} " + " UNION ALL ".join(parts)


KNOWN_STATUS = "CASE WHEN o_orderstatus NOT IN ('', 'na') THEN o_orderstatus END AS o_orderstatus"
GUESS = "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN toxic + 0.9::DOUBLE ELSE toxic END"


def _fold_scores(score: str) -> str:
    """A straight line fitted on two of three folds of the train side, scored on the third."""
    return f"""WITH {_split('orders', 'o_orderkey', None)},
  train AS (SELECT o_orderkey, o_custkey, o_totalprice, 0 AS one FROM split WHERE split = 'train'),
  folds AS ({_folds('train', 'o_orderkey', 'one', 3)}),
  fit AS (SELECT k.f, regr_slope(o_totalprice, o_custkey) AS a, regr_intercept(o_totalprice, o_custkey) AS b
          FROM folds, (SELECT unnest(range(3)) AS f) k WHERE fold <> k.f GROUP BY 1),
  t AS (SELECT fold, o_totalprice AS y, a * o_custkey + b AS p FROM folds JOIN fit ON fold = f)
  SELECT fold, round({score}, 4) AS score FROM t GROUP BY fold"""


WEIGHT = "((({i} - 1) % 7) - 3) / 10.0::DOUBLE"

ORACLES: dict[str, str] = {
    "profile_flags": f"WITH {DIRTY} {_profile('dirty', DIRTY_COLUMNS, 6)}",
    "diagnose_part": _profile("part", PART_COLUMNS, 20, offset=1),
    "column_lists": _column_lists(),
    "fill_rate": f"WITH {DIRTY} " + _per_column("round(100.0::DOUBLE * count({c}) / count(*), 6)", "fill_rate"),
    "missing_pct_top": f"WITH {DIRTY}, r AS ({_per_column('round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 6)', 'missing_pct')}) "
                       "SELECT \"column\", missing_pct FROM r ORDER BY missing_pct DESC, \"column\" LIMIT 4",
    "distinct_counts": f"WITH {DIRTY} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, "
        f"count(DISTINCT {c}) + (count({c}) < count(*))::INT AS n_with_null FROM dirty" for c, _, _ in DIRTY_COLUMNS),
    "describe_numeric": _describe("events", ["user_id", "value"]),
    "describe_with_gaps": f"WITH {DIRTY} " + _describe("dirty", ["o_custkey", "o_totalprice", "sparse_col", "empty_col"]),
    "column_info": f"WITH {DIRTY} " + _per_column("count({c})", "non_null", ", {i}::INTEGER AS position, '{dtype}' AS dtype"),
    "class_share": f"WITH {DIRTY} SELECT round(100.0::DOUBLE * avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 6) AS share FROM dirty",
    "drop_empty_columns": f"WITH {DIRTY} SELECT * EXCLUDE (empty_col) FROM dirty",
    "file_encodings": """SELECT lang, CASE WHEN bool_and(octet_length(encode(text)) = length(text)) THEN 'ascii' ELSE 'utf-8' END AS encoding,
        CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY lang""",
    "drop_columns": f"WITH {DIRTY} SELECT * EXCLUDE (empty_col, sparse_col, const_col) FROM dirty",
    "select_existing": f"WITH {DIRTY} SELECT is_even, o_orderkey FROM dirty",
    "known_rows": f"WITH {DIRTY} SELECT o_orderkey, o_totalprice FROM dirty WHERE o_totalprice IS NOT NULL",
    "head_by_key": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "duplicate_rows_first": _duplicates("", "r > 1"),
    "duplicate_rows_last": _duplicates("DESC", "r > 1"),
    "duplicate_rows_none": _duplicates("", "n > 1"),
    "duplicate_rows_ordered": "SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
                              "ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
                              "l_returnflag, l_linestatus) r FROM lineitem) WHERE r > 1",
    "duplicate_rows_identical": "SELECT l_returnflag, l_linestatus, l_linenumber, l_discount FROM (SELECT *, row_number() OVER "
                                "(PARTITION BY l_returnflag, l_linestatus, l_linenumber, l_discount) r FROM lineitem) WHERE r > 1",
    "count_duplicates": "SELECT count(*) - count(DISTINCT text) AS n_duplicates FROM documents",
    "count_duplicates_lines": "SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicates FROM lineitem",
    "key_duplicates": "SELECT count(*) - count(DISTINCT (conv_id, turn)) AS n_duplicates FROM conversations",
    "bool_to_uint8_keep": f"WITH {DIRTY} SELECT o_orderkey, CAST(is_even AS TINYINT) AS is_even FROM dirty",
    "bool_to_uint8_zero": f"WITH {DIRTY} SELECT o_orderkey, coalesce(CAST(is_even AS TINYINT), 0::TINYINT) AS is_even FROM dirty",
    "lower_text": "SELECT * REPLACE (lower(text) AS text) FROM documents",
    "keyword_type": "SELECT o_orderkey, CASE " + " ".join(
        f"WHEN regexp_matches(o_orderpriority, '{k}') THEN '{v}'" for k, v in KEYWORDS.items()) + " END AS type FROM orders",
    "normalize_text": "SELECT doc_id, strip_accents(lower(text)) AS text FROM documents",
    "normalize_all_text": "SELECT conv_id, turn, strip_accents(lower(role)) AS role, strip_accents(lower(text)) AS text FROM conversations",
    "to_numeric": f"WITH {DIRTY} SELECT o_orderkey, try_cast(floor_txt AS DOUBLE) AS floor_txt FROM dirty",
    "replace_invalid": f"WITH {DIRTY}, n AS (SELECT o_orderkey, CASE WHEN floor_txt = 'bajo' THEN 0 ELSE try_cast(floor_txt AS DOUBLE) END AS v FROM dirty) "
                       "SELECT o_orderkey, CASE WHEN v >= 2 THEN v END AS floor_txt FROM n",
    "log1p_price": "SELECT c_custkey, CASE WHEN c_acctbal > -1 THEN round(ln(1 + c_acctbal), 6) END AS c_acctbal FROM customer",
    **{f"impute_{name}": f"WITH {DIRTY} SELECT o_orderkey, " + ", ".join(
        f"round(coalesce({c}, {fill.format(c=c)}), 4) AS {c}" for c in ("o_totalprice", "sparse_col")) + " FROM dirty"
       for name, fill in (("median", "median({c}) OVER ()"), ("mean", "avg({c}) OVER ()"), ("zero", "0"))},
    "impute_categorical": f"WITH {DIRTY} SELECT o_orderkey, coalesce(o_orderstatus, 'missing') AS o_orderstatus FROM dirty",
    "impute_mode": f"WITH {DIRTY} SELECT o_orderkey, " + ", ".join(
        f"coalesce({c}, (SELECT {c} FROM dirty WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS {c}"
        for c in ("is_even", "o_orderstatus", "floor_txt")) + " FROM dirty",
    "corr_matrix": _matrix("lineitem", LINE_NUMBERS),
    "corr_matrix_with_gaps": f"WITH {DIRTY} " + _matrix("dirty", ["o_totalprice", "sparse_col", "o_custkey", "empty_col"]),
    "corr_matrix_wide": "WITH wide AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in WIDE_COLUMNS.items()) + " FROM lineitem) " + " UNION ALL ".join(
        f"SELECT '{b}' AS \"row\", '{a}' AS col, round(corr({b}, {a}), 6) AS corr FROM wide" for a, b in itertools.combinations(WIDE_COLUMNS, 2)),
    "corr_matrix_lower": _matrix("lineitem", LINE_NUMBERS, only_lower=True),
    "collinear_pairs": "WITH m AS (SELECT *, l_quantity * 2 + l_tax AS mixed FROM lineitem) SELECT feature1, feature2, abs_corr FROM (" + " UNION ALL ".join(
        f"SELECT '{b}' AS feature1, '{a}' AS feature2, round(abs(corr({b}, {a})), 6) AS abs_corr FROM m"
        for i, a in enumerate(LINE_NUMBERS + ["mixed"]) for b in (LINE_NUMBERS + ["mixed"])[i + 1:]) + ") WHERE abs_corr > 0.8",
    "target_corr_top": _target_corr(" LIMIT 3"),
    "target_corr_bars": _target_corr("", ", 'returned' AS target"),
    "spearman": _spearman("lineitem", [(LINE_NUMBERS[i], LINE_NUMBERS[j]) for i in range(4) for j in range(i)]),
    "spearman_with_gaps": f"WITH {DIRTY} " + _spearman("dirty", [("sparse_col", "o_totalprice")]),
    "kendall": _kendall([(TIED_NUMBERS[i], TIED_NUMBERS[j]) for i in range(4) for j in range(i)]),
    "kendall_wide": "WITH w AS (SELECT value, epoch_us(ts) / 1e6 AS seconds, CASE WHEN event_id % 3 <> 0 THEN value + user_id END AS gaps, user_id "
                    "FROM events) " + _kendall([(c, d) for c, d in itertools.combinations(["user_id", "gaps", "seconds", "value"], 2)], "w"),
    "histogram_40": _bins("events", "value", True),
    "histogram_all_columns": " UNION ALL ".join(f"({_bins('lineitem', c, False)})" for c in LINE_NUMBERS),
    "histogram_with_gaps": f"WITH {DIRTY} " + " UNION ALL ".join(
        f"({_bins('dirty', c, False)})" for c in ("o_totalprice", "sparse_col")),
    "value_counts_top": _value_counts("documents", [("lang", "lang"), ("source", "source")], 5),
    "value_counts_with_gaps": f"WITH {DIRTY} " + _value_counts("dirty", [
        (c, c) if k == "string" else (c, f"CASE {c} WHEN true THEN 'True' WHEN false THEN 'False' END")
        for c, k, _ in DIRTY_COLUMNS if k in ("string", "boolean")], 4),
    "target_counts": f"WITH {DIRTY} SELECT o_orderstatus, count(*) AS n FROM dirty GROUP BY 1",
    "scatter_log1p": f"WITH {DIRTY} " + " UNION ALL ".join(
        f"SELECT o_orderkey, '{c}' AS \"column\", {c} AS x, round(ln(1 + o_custkey), 6) AS y FROM dirty WHERE {c} IS NOT NULL"
        for c in ("o_totalprice", "sparse_col")),
    "clean_fit_apply": _clean(),
    "stratified_split_ids": f"WITH {_split('orders', 'o_orderkey', 'o_orderstatus')} SELECT o_orderkey, split FROM split",
    "stratified_split_counts": f"WITH {_split('orders', 'o_orderkey', 'o_orderstatus')} SELECT o_orderstatus, split, count(*) AS n FROM split GROUP BY 1, 2",
    "split_sizes": f"WITH {_split('orders', 'o_orderkey', None)} SELECT split, count(*) AS n_rows, 6::INTEGER AS n_columns FROM split GROUP BY 1",
    "stratified_folds": f"SELECT o_orderkey, fold FROM ({_folds('orders', 'o_orderkey', 'o_orderstatus', 5)})",
    "robust_scale": "SELECT l_orderkey, l_linenumber, " + ", ".join(map(_scaled, LINE_NUMBERS)) + " FROM lineitem",
    "one_hot_drop_first": "SELECT o_orderkey, " + ", ".join(
        [f"(o_orderstatus = '{v}')::TINYINT AS \"cat__o_orderstatus_{v}\"" for v in ("O", "P")]
        + [f"(o_orderpriority = '{v}')::TINYINT AS \"cat__o_orderpriority_{v}\"" for v in PRIORITIES]) + " FROM orders",
    "preprocess_train_test": f"""WITH {DIRTY}, {_split('dirty', 'o_orderkey', 'o_orderpriority', 'd')},
  q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, median(o_totalprice) AS q2, quantile_cont(o_totalprice, 0.75) AS q3 FROM d WHERE split = 'train')
  SELECT o_orderkey, split, round((o_totalprice - q2) / (q3 - q1), 6) AS "num__o_totalprice", """ + ", ".join(
        [f"coalesce(o_orderstatus = '{v}', false)::TINYINT AS \"cat__o_orderstatus_{v}\"" for v in ("F", "O", "P", "na")]
        + ["(o_orderstatus IS NULL)::TINYINT AS \"cat__o_orderstatus_None\"",
           "coalesce(is_even, false)::TINYINT AS \"cat__is_even_True\"", "(is_even IS NULL)::TINYINT AS \"cat__is_even_None\""]) + " FROM d, q",
    "feature_vectors": _slots(),
    "label_encode": "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS code FROM orders",
    "class_codes_text": "SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) - 1 AS code FROM customer",
    "class_codes_numeric": "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_custkey) - 1 AS code FROM orders",
    "label_encode_int8": "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS TINYINT) AS code FROM orders",
    "attach_target": "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders",
    "accuracy": "SELECT round(avg((quality = toxic)::INT::DOUBLE), 6) AS accuracy FROM labels",
    "confusion": "SELECT a.v::INTEGER AS actual, p.v::INTEGER AS predicted, (SELECT count(*) FROM labels WHERE quality = a.v AND toxic = p.v) AS n "
                 "FROM (SELECT unnest([0, 1]) AS v) a, (SELECT unnest([0, 1]) AS v) p",
    "class_report": f"WITH g AS (SELECT quality AS y, toxic AS p FROM labels), {REPORT}",
    "regression_metrics": "SELECT round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2, round(sqrt(avg((y - p) ** 2)), 6) AS rmse, "
                          "round(avg(abs(y - p)), 6) AS mae FROM (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)",
    "baseline_most_frequent": "SELECT doc_id, (SELECT quality FROM labels GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)::INTEGER AS prediction FROM labels",
    "baseline_prior": "SELECT doc_id, (SELECT quality FROM labels GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)::INTEGER AS prediction FROM labels",
    "baseline_stratified": f"SELECT doc_id, (CASE WHEN {DRAW} < (SELECT avg((quality = 0)::INT::DOUBLE) FROM labels) THEN 0 ELSE 1 END)::INTEGER AS prediction FROM labels",
    "baseline_uniform": f"SELECT doc_id, (CASE WHEN {DRAW} < 0.5 THEN 0 ELSE 1 END)::INTEGER AS prediction FROM labels",
    "baseline_search": _searched([(s, SEED) for s in STRATEGIES], 5) + " SELECT strategy, mean_score, std_score, rank FROM ranked",
    "random_search": _searched(RANDOM_CANDIDATES, 3) + " SELECT candidate, strategy, seed, mean_score, rank FROM ranked",
    "baseline_report": f"WITH {_split('labels', 'doc_id', 'quality')}, best AS (SELECT quality AS p FROM split WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), "
                       f"g AS (SELECT quality AS y, p FROM split, best WHERE split = 'test'), {REPORT}",
    "regression_search": f"""WITH {_split('orders', 'o_orderkey', None)},
  fit AS (SELECT regr_slope(o_totalprice, o_custkey) AS a, regr_intercept(o_totalprice, o_custkey) AS b FROM split WHERE split = 'train'),
  t AS (SELECT o_totalprice AS y, a * o_custkey + b AS p FROM split, fit WHERE split = 'test')
  SELECT round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2, round(sqrt(avg((y - p) ** 2)), 4) AS rmse,
         round(avg(abs(y - p)), 4) AS mae FROM t""",
    "first_study": _study(),
    "perceptron_score": "SELECT vec_id, round(s, 6) AS weighted_sum, (s >= 0.05)::INTEGER AS output FROM (SELECT vec_id, "
                        f"list_sum(list_transform(embedding, lambda x, i: x::DOUBLE * {WEIGHT.format(i='i')})) + 0.01::DOUBLE AS s FROM embeddings)",
    "perceptron_columns": "SELECT l_orderkey, l_linenumber, round(s, 6) AS weighted_sum, (s >= -5)::INTEGER AS output FROM (SELECT *, "
                          "l_quantity * 0.4::DOUBLE + l_extendedprice * -0.0003::DOUBLE + l_discount * 2 + l_tax AS s FROM lineitem)",
    "perceptron_partial_sums": f"""SELECT vec_id, pos, round(x, 6) AS x, w, round(x * w, 6) AS product,
  round(sum(x * w) OVER (PARTITION BY vec_id ORDER BY pos ROWS UNBOUNDED PRECEDING), 6) AS running_sum FROM (
  SELECT vec_id, (i - 1)::INTEGER AS pos, embedding[i]::DOUBLE AS x, {WEIGHT.format(i='i')} AS w FROM (
  SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))""",
    "random_terms": f"""SELECT c_custkey, pos::INTEGER AS pos,
  CAST(CAST('0x' || substr({_digest('c_custkey', 'pos', f"'{SEED}'", "'x'")}, 1, 13) AS BIGINT) % 11 AS INTEGER) AS x,
  round({_unit('c_custkey', 'pos', f"'{SEED}'", "'w'")}, 9) AS w
  FROM (SELECT c_custkey, unnest(range(4)) AS pos FROM customer)""",
    "csv_roundtrip": f"WITH {DIRTY} SELECT * REPLACE ({KNOWN_STATUS}, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate) FROM dirty",
    "csv_with_schema": f"WITH {DIRTY} SELECT * REPLACE ({KNOWN_STATUS}) FROM dirty",
    "csv_documents": "SELECT * FROM documents",
    "csv_latin1": "SELECT * REPLACE ('É' || c_name || 'ñ' AS c_name) FROM customer",
    "csv_key_by_position": "SELECT o_orderkey, o_custkey, o_totalprice AS unnamed FROM orders",
    "features_part": "SELECT * EXCLUDE (o_totalprice) FROM orders",
    "target_part": "SELECT o_totalprice FROM orders",
    "value_counts_all": _value_counts("customer", [("c_name", "c_name"), ("c_mktsegment", "c_mktsegment")], 1 << 62),
    "random_vectors": f"SELECT c_custkey, round(list_sum(list_transform(range(4), lambda pos: "
                      f"(CAST('0x' || substr({_digest('c_custkey', 'pos', f"'{SEED}'", "'x'")}, 1, 13) AS BIGINT) % 11) * "
                      f"{_unit('c_custkey', 'pos', f"'{SEED}'", "'w'")})), 6) AS total FROM customer",
    "confusion_pivot": "SELECT quality AS actual, count(*) FILTER (toxic = 0) AS predicted_0, count(*) FILTER (toxic = 1) AS predicted_1, "
                       "count(*) FILTER (toxic NOT IN (0, 1)) AS other FROM labels GROUP BY 1",
    "confusion_with_gaps": f"SELECT quality::DOUBLE AS actual, {GUESS} AS predicted, count(*) AS n FROM labels GROUP BY 1, 2",
    "class_report_with_gaps": f"WITH g AS (SELECT quality AS y, {GUESS} AS p FROM labels), "
                              + REPORT.replace("sum(hits)::DOUBLE / sum(support), sum(support)::BIGINT FROM s",
                                               "(SELECT sum(hits) FROM s)::DOUBLE / count(*), count(*) FROM g", 1),
    "scores_by_name": f"""WITH g AS (SELECT quality AS y, toxic AS p FROM labels), r AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem),
  {REPORT.split("lines AS (")[0].strip().rstrip(",")}
  SELECT 'accuracy' AS scoring, round(avg((y = p)::INT::DOUBLE), 4) AS score FROM g
  UNION ALL SELECT 'f1_macro', round(avg(f1_score), 4) FROM s
  UNION ALL SELECT 'f1_weighted', round(sum(f1_score * support) / sum(support), 4) FROM s
  UNION ALL SELECT 'r2', round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 4) FROM r
  UNION ALL SELECT 'neg_root_mean_squared_error', round(-sqrt(avg((y - p) ** 2)), 4) FROM r
  UNION ALL SELECT 'neg_mean_absolute_error', round(-avg(abs(y - p)), 4) FROM r""",
    "regression_folds_rmse": _fold_scores("-sqrt(avg((y - p) ** 2))"),
    "regression_folds_mae": _fold_scores("-avg(abs(y - p))"),
    "export_split": f"WITH {_split('orders', 'o_orderkey', 'o_orderstatus')} SELECT * EXCLUDE (o_orderdate) FROM split",
    "page_encodings": "SELECT page_id, CASE WHEN strlen(html) = length(html) THEN 'ascii' ELSE 'utf-8' END AS encoding FROM pages",
    "export_sides": f"WITH {_split('orders', 'o_orderkey', 'o_orderstatus')} SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, "
                    "round(ln(1 + o_totalprice), 6) AS log_price, split AS side FROM split",
}
