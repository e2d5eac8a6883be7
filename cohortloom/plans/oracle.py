"""The queries of the catalog as SQL over the same tables, written independently."""

from __future__ import annotations

from cohortloom.plans import catalog as c
from cohortloom.plans import jobs
from cohortloom.plans import views as v

# Shared building blocks (common table expressions).

ENTITY_TEXT = """
text_of AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS entity_id,
  concat('Patient: ', lpad(CAST(c_custkey AS VARCHAR), 6, '0'), chr(10),
   'Age: ', CASE WHEN c_custkey % 17 = 0 THEN 'nan' ELSE CAST(c_custkey % 90 AS VARCHAR) END, chr(10),
   'Sex: ', CASE c_nationkey % 4 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' WHEN 2 THEN 'Other'
            ELSE 'nan' END, chr(10),
   'ROSC: ', CASE WHEN c_custkey % 5 = 0 THEN 'nan' ELSE CAST(c_custkey % 60 AS VARCHAR) END, chr(10),
   'OHCA: ', CASE c_custkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE 'nan' END, chr(10),
   'VFib: ', CASE WHEN c_custkey % 2 = 0 THEN 'True' ELSE 'False' END, chr(10),
   CASE WHEN c_custkey % 4 = 0 THEN ''
        ELSE concat('TTM: ', CAST(33 + 3 * (c_custkey % 2) AS VARCHAR), chr(10)) END,
   'Outcome: ', CASE WHEN c_acctbal < 0 THEN 'Poor' ELSE 'Good' END, chr(10),
   'CPC: ', CAST(1 + c_custkey % 5 AS VARCHAR)) AS text FROM customer)"""

# Text fields read back line by line, independent of the engine's pattern.
FIELDS = ENTITY_TEXT + """,
line_of AS (SELECT entity_id, unnest(string_split(text, chr(10))) AS line FROM text_of),
pair_of AS (SELECT entity_id, split_part(line, ':', 1) AS k, trim(split_part(line, ':', 2)) AS v
  FROM line_of),
field_of AS (SELECT entity_id,
   max(CASE WHEN k = 'Patient' THEN v END) AS patient,
   max(CASE WHEN k = 'Age' AND v <> 'nan' THEN CAST(v AS DOUBLE) END) AS age,
   max(CASE WHEN k = 'Sex' AND v <> 'nan' THEN v END) AS sex,
   max(CASE WHEN k = 'ROSC' AND v <> 'nan' THEN CAST(v AS DOUBLE) END) AS rosc,
   max(CASE WHEN k = 'OHCA' THEN CASE v WHEN 'True' THEN 1 WHEN 'False' THEN 0 END END) AS ohca,
   max(CASE WHEN k = 'VFib' THEN CASE v WHEN 'True' THEN 1 WHEN 'False' THEN 0 END END) AS vfib,
   max(CASE WHEN k = 'TTM' THEN CAST(v AS DOUBLE) END) AS ttm,
   max(CASE WHEN k = 'Outcome' THEN v END) AS outcome,
   CAST(NULL AS DOUBLE) AS outcome_probability,
   max(CASE WHEN k = 'CPC' THEN CAST(v AS DOUBLE) END) AS cpc
  FROM pair_of GROUP BY entity_id),
meta_of AS (SELECT entity_id, age, CASE WHEN sex = 'Female' THEN 1 ELSE 0 END AS female,
   CASE WHEN sex = 'Male' THEN 1 ELSE 0 END AS male,
   CASE WHEN sex IN ('Female', 'Male') THEN 0 ELSE 1 END AS other, rosc, ohca, vfib, ttm
  FROM field_of)"""

INDEX = """
index_of AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS entity_id, CAST(rn - 1 AS INTEGER) AS seq,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(6 * (rn - 1) + o_orderkey % 6 AS DOUBLE) END AS hour,
  concat(lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0'), ':00:00') AS "time",
  CAST(o_orderkey % 100 AS DOUBLE) / 100 AS quality,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS record_id
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
        FROM orders) t)"""

ORDER_SAMPLES = """
order_sample AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS entity_id,
  CAST(o_orderkey AS VARCHAR) AS record_id, concat('L', CAST(l_linenumber AS VARCHAR)) AS channel,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS raw
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SAMPLES = """
sample_of AS (SELECT *, CAST(CAST((raw - 10) / 50.0 AS FLOAT) AS DOUBLE) AS value FROM (
  SELECT CAST(user_id % 10 AS INTEGER) AS entity_id, CAST(extract(day FROM ts) % 3 AS INTEGER) AS record_id,
    event_type AS channel,
    CAST(row_number() OVER (PARTITION BY user_id % 10, extract(day FROM ts) % 3, event_type
      ORDER BY ts, event_id) - 1 AS INTEGER) AS idx,
    CAST(round(value * 100) AS BIGINT) AS raw FROM events) t)"""

SPEC = SAMPLES + """,
spec_of AS (SELECT entity_id, record_id, channel, count(*) AS num_samples,
  max(CASE WHEN idx = 0 THEN raw END) AS first_raw, sum(raw) AS total,
  concat(entity_id, '_', record_id, CASE WHEN entity_id % 3 = 2 AND record_id = 1 AND channel = 'click'
    THEN '_b' ELSE '' END, '.mat') AS signal_file,
  max(CASE WHEN idx = 0 THEN raw END) + CASE WHEN entity_id % 4 = 1 AND channel = 'view' THEN 1 ELSE 0 END
    AS initial_value,
  sum(raw) + CASE WHEN entity_id % 5 = 0 AND channel = 'error' THEN 1 ELSE 0 END AS checksum
  FROM sample_of GROUP BY entity_id, record_id, channel),
longest_of AS (SELECT entity_id, record_id, max(num_samples) AS longest, count(*) AS n_channels,
  count(DISTINCT signal_file) AS n_files
  FROM spec_of GROUP BY entity_id, record_id)"""

USER_SAMPLES = """
user_sample AS (SELECT *, CAST(CAST((raw - 10) / 50.0 AS FLOAT) AS DOUBLE) AS value FROM (
  SELECT lpad(CAST(user_id AS VARCHAR), 6, '0') AS entity_id,
    CAST((extract(day FROM ts) - 1) // 15 AS INTEGER) AS block, event_type AS channel,
    row_number() OVER (PARTITION BY user_id, (extract(day FROM ts) - 1) // 15, event_type
      ORDER BY ts, event_id) - 1 AS idx,
    CAST(round(value * 100) AS BIGINT) AS raw FROM events) t)"""

CELLS_N = "CAST(o_custkey AS VARCHAR)"
CELL_SPELLINGS = [
    CELLS_N, f"concat(' ', {CELLS_N}, chr(9))", f"concat({CELLS_N}, '.0')",
    f"concat({CELLS_N}, '.5')", f"concat('1_', {CELLS_N})", f"concat({CELLS_N}, 'd')",
    f"concat({CELLS_N}, 'f')", f"concat('0x', {CELLS_N})", "'inf'", "'-inf'", "'Infinity'", "'nan'",
    "'NaN'", "'+nan'", "'True'", "'t'", "'F'", "'false'", "'yes'", f"concat('\"', {CELLS_N}, '\"')",
    "'[1]'", "'''0'''", f"concat({CELLS_N}, ' 0')", "''", f"concat({CELLS_N}, 'e3')",
    "concat('_', '1')", "'1__0'",
]
CELLS = (
    "cell AS (SELECT o_orderkey AS cell_id, CASE o_orderkey % "
    + f"{len(CELL_SPELLINGS)} "
    + " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(CELL_SPELLINGS))
    + " END AS raw FROM orders)"
)
BLANK = (
    "\\x{09}-\\x{0d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
)


NUMBER_BLANK = BLANK.replace("\\x{1c}-\\x{20}", "\\x{20}")


def _strip(x: str, blank: str = BLANK) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[{blank}]+', ''), '[{blank}]+$', '')"


def _markup(x: str) -> str:
    inner = f"replace(replace(replace(replace(replace({x}, '\"', ''), '''', ''), '[', ''), ']', ''), ' ', '')"
    return _strip(inner)


def _number(x: str) -> str:
    """NULL if no number, else DOUBLE with NaN and infinities."""
    s = _strip(x, NUMBER_BLANK)
    return f"""CASE
      WHEN lower({s}) IN ('nan', '+nan', '-nan') THEN CAST('nan' AS DOUBLE)
      WHEN lower({s}) IN ('inf', '+inf', 'infinity', '+infinity') THEN CAST('inf' AS DOUBLE)
      WHEN lower({s}) IN ('-inf', '-infinity') THEN CAST('-inf' AS DOUBLE)
      WHEN regexp_full_match({s}, '[+-]?([0-9]+(_[0-9]+)*[.]?([0-9]+(_[0-9]+)*)?|[.][0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?')
        THEN TRY_CAST(replace({s}, '_', '') AS DOUBLE) END"""


TRUE_LIST = "('True', 'true', 'TRUE', 'T', 't')"
FALSE_LIST = "('False', 'false', 'FALSE', 'F', 'f')"


def _classes(x: str) -> str:
    n = _number(x)
    return f"""({n}) IS NOT NULL AS is_number,
      coalesce(isfinite({n}) AND ({n}) = trunc({n}), false) AS is_integer,
      coalesce(({n}) IN (0.0, 1.0), false) OR coalesce({_markup(x)} IN {TRUE_LIST}
        OR {_markup(x)} IN {FALSE_LIST}, false) AS is_boolean,
      coalesce(isfinite({n}), false) AS is_finite_number,
      coalesce(isnan({n}), false) AS is_nan"""


def _cast(kind: str) -> str:
    n = _number(_markup("raw"))
    value = {
        "float": f"CASE WHEN NOT isnan({n}) THEN {n} END",
        "int": f"CASE WHEN isfinite({n}) AND ({n}) = trunc({n}) THEN {n} END",
        "bool": f"CASE WHEN ({n}) = 0 OR {_markup('raw')} IN {FALSE_LIST} THEN 0 "
        f"WHEN ({n}) = 1 OR {_markup('raw')} IN {TRUE_LIST} THEN 1 END",
        "string": f"CASE WHEN NOT coalesce(isnan({_number('raw')}), false) THEN raw END",
    }[kind]
    return f"WITH {CELLS} SELECT cell_id, {value} AS value FROM cell"


def _signature(shingle_cte: str, source: str, hashes: int = c.NUM_HASHES) -> str:
    """Minimum of every hash function per entity, shingle by shingle."""
    return f"""{shingle_cte},
fp AS (SELECT DISTINCT entity_id, CAST(concat('0x', substr(md5(shingle), 1, 7)) AS BIGINT) AS hi,
  CAST(concat('0x', substr(md5(shingle), 8, 7)) AS BIGINT) AS lo FROM {source}),
fam AS (SELECT i, 1 + CAST(concat('0x', substr(md5(concat('a', i)), 1, 7)) AS BIGINT) AS a,
  CAST(concat('0x', substr(md5(concat('b', i)), 1, 7)) AS BIGINT) AS b,
  1 + CAST(concat('0x', substr(md5(concat('c', i)), 1, 7)) AS BIGINT) AS c
  FROM range({hashes}) r(i)),
mh AS (SELECT entity_id, i, min((a * hi + c * lo + b) % 2147483647) AS h
  FROM fp CROSS JOIN fam GROUP BY entity_id, i)"""


DOCUMENT_SHINGLES = """
sh AS (SELECT entity_id, shingle FROM (
  SELECT doc_id AS entity_id, unnest(string_split(lower(text), ' ')) AS shingle FROM documents) t
  WHERE shingle <> '')"""
SIGNATURES = _signature(DOCUMENT_SHINGLES, "sh")


def _bands(hashes: int, bands: int) -> str:
    rows = hashes // bands
    return _signature(DOCUMENT_SHINGLES, "sh", hashes) + f""",
band_of AS (SELECT entity_id, CAST(i // {rows} AS INTEGER) AS band,
  md5(string_agg(CAST(h AS VARCHAR), ',' ORDER BY i)) AS band_key FROM mh GROUP BY entity_id, i // {rows})"""


def _targets(count: int) -> str:
    return f"""
tgt AS (SELECT doc_id AS entity_id FROM documents
  ORDER BY md5(concat('{c.SEED}', CAST(doc_id AS VARCHAR))), doc_id LIMIT {count})"""


def _scored(hashes: int, bands: int, targets: int) -> str:
    """Candidates by shared bands, compared by the sets of their signature values."""
    return _bands(hashes, bands) + "," + _targets(targets) + """,
cand AS (SELECT DISTINCT t.entity_id AS target_id, o.entity_id AS check_id
  FROM band_of t JOIN band_of o ON t.band = o.band AND t.band_key = o.band_key
  WHERE t.entity_id IN (SELECT entity_id FROM tgt) AND o.entity_id NOT IN (SELECT entity_id FROM tgt)),
vals AS (SELECT DISTINCT entity_id, h FROM mh),
card AS (SELECT entity_id, count(*) AS n FROM vals GROUP BY entity_id),
common AS (SELECT target_id, check_id, count(*) AS k FROM cand
  JOIN vals x ON x.entity_id = target_id JOIN vals y ON y.entity_id = check_id AND y.h = x.h
  GROUP BY target_id, check_id),
scored AS (SELECT target_id, check_id, CAST(k AS DOUBLE) / (x.n + y.n - k) AS similarity
  FROM common JOIN card x ON x.entity_id = target_id JOIN card y ON y.entity_id = check_id)"""


BAND_ROWS = _bands(c.NUM_HASHES, c.BANDS)
TARGETS = _targets(c.TARGETS)
SCORED = _scored(c.NUM_HASHES, c.BANDS, c.TARGETS)
FULL_SIZE = _scored(jobs.NUM_HASHES, jobs.BANDS, jobs.TARGETS)

SHINGLES_OF_SIGNALS = SAMPLES + """,
sh AS (SELECT entity_id, string_agg(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.0', ',' ORDER BY channel)
  AS shingle, record_id FROM sample_of GROUP BY entity_id, record_id, idx)"""

PAIRS = """
pairs AS (SELECT event_id AS entity_id, CAST(floor(value) AS BIGINT) % 50 AS actual,
  CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) % 50 AS predicted FROM events)"""
LABELS = "pairs AS (SELECT doc_id AS entity_id, quality AS actual, toxic AS predicted FROM labels)"
RANKS = """
diffs AS (SELECT entity_id, actual - predicted AS diff FROM pairs WHERE actual <> predicted),
ranked AS (SELECT entity_id, diff, rank() OVER (ORDER BY abs(diff)) AS low,
  count(*) OVER (PARTITION BY abs(diff)) AS ties FROM diffs)"""


def _psd(cte: str, source: str, keys: str, n: int, fs: float) -> str:
    """Plain discrete Fourier transform of whole segments of n samples."""
    return f"""{cte},
seg AS (SELECT {keys}, idx // {n} AS seg, idx % {n} AS j, value,
  avg(value) OVER (PARTITION BY {keys}, idx // {n}) AS centre,
  count(*) OVER (PARTITION BY {keys}, idx // {n}) AS filled FROM {source}),
win AS (SELECT j, 0.54 - 0.46 * cos(2 * pi() * j / {n}) AS w FROM range({n}) r(j)),
twiddle AS (SELECT k, j, w, cos(2 * pi() * k * j / {n}) AS re, sin(2 * pi() * k * j / {n}) AS im
  FROM win CROSS JOIN range({n // 2 + 1}) q(k)),
dft AS (SELECT {keys}, seg, k, sum((value - centre) * w * re) AS re, sum((value - centre) * w * im) AS im
  FROM seg JOIN twiddle USING (j) WHERE filled = {n} GROUP BY {keys}, seg, k),
psd_of AS (SELECT {keys}, CAST(k AS INTEGER) AS bin, k * {fs} / {n} AS frequency,
  avg((re * re + im * im) * CASE WHEN k IN (0, {n} / 2) THEN 1 ELSE 2 END)
    / ({fs} * (SELECT sum(w * w) FROM win)) AS psd FROM dft GROUP BY {keys}, k)"""


BAND_LIMITS = {"delta": (0.5, 8), "theta": (4, 8), "alpha": (8, 12), "beta": (12, 30)}


def _band_columns(digits: int = 6) -> str:
    return ", ".join(
        f"round(avg(CASE WHEN frequency BETWEEN {low} AND {high} THEN psd END), {digits}) AS {b}"
        for b, (low, high) in BAND_LIMITS.items()
    )


def _permutation(cte: str, permutations: int) -> str:
    return f"""{cte},
pool AS (SELECT 'a' || entity_id AS row_id, true AS is_x, CAST(round(actual * 1000000000) AS HUGEINT) AS val FROM pairs
  WHERE actual IS NOT NULL UNION ALL
  SELECT 'p' || entity_id, false, CAST(round(predicted * 1000000000) AS HUGEINT) FROM pairs WHERE predicted IS NOT NULL),
size AS (SELECT count(*) FILTER (is_x) AS n_x, count(*) FILTER (NOT is_x) AS n_y,
  sum(val) FILTER (is_x) AS s_x, sum(val) FILTER (NOT is_x) AS s_y FROM pool),
shuffled AS (SELECT perm, val, row_number() OVER (PARTITION BY perm
  ORDER BY md5(concat_ws('|', '{c.SEED}', perm, row_id)), row_id) AS place
  FROM pool CROSS JOIN range({permutations}) r(perm)),
sums AS (SELECT perm, sum(CASE WHEN place <= n_x THEN val ELSE 0 END) AS s1,
  sum(CASE WHEN place > n_x THEN val ELSE 0 END) AS s2 FROM shuffled CROSS JOIN size GROUP BY perm),
perm_of AS (SELECT any_value(n_x) AS n_x, any_value(n_y) AS n_y,
  any_value(abs(CAST(s_x AS DOUBLE) / n_x - CAST(s_y AS DOUBLE) / n_y)) / 1e9 AS statistic,
  count(*) AS n_permutations,
  count(*) FILTER (abs(s1 * n_y - s2 * n_x) > abs(s_x * n_y - s_y * n_x)) AS n_above
  FROM sums CROSS JOIN size)"""


PERMUTATION_COLUMNS = """SELECT n_x, n_y, round(statistic, 6) AS statistic, n_permutations, n_above,
  CAST(n_above AS DOUBLE) / n_permutations AS p_value FROM perm_of"""


def _normal_p(z: str, source: str, out: str) -> str:
    """Two-sided normal p by Simpson's rule over [0, |z|], 2000 intervals."""
    return f"""
{out}_z AS (SELECT least(abs({z}), 40.0) AS az FROM {source}),
{out} AS (SELECT greatest(0, 1 - 2 * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
  * exp(-0.5 * (az * i / 2000) * (az * i / 2000)) / sqrt(2 * pi())) * any_value(az) / 2000 / 3) AS p
  FROM {out}_z CROSS JOIN range(2001) r(i))"""


WALD = """
moments AS (SELECT avg(actual) - avg(predicted) AS d,
  var_samp(actual) / count(actual) + var_samp(predicted) / count(predicted) AS s FROM pairs),
wald AS (SELECT d / sqrt(s) AS z FROM moments),""" + _normal_p("z", "wald", "wald_p")
SIMPLE = """
simple AS (SELECT count(*) AS n, least(sum(CASE WHEN diff > 0 THEN low ELSE 0 END),
  sum(CASE WHEN diff < 0 THEN low ELSE 0 END)) AS t FROM ranked),
simple_p AS (SELECT n, CAST(t AS DOUBLE) AS statistic,
  2 * (1 - abs((t - 0.5) / (CAST(n AS DOUBLE) * (n + 1) * (2 * n + 1) / 6))) AS p FROM simple)"""
NORMAL = """
mean_rank AS (SELECT count(*) AS n,
  least(sum(CASE WHEN diff > 0 THEN low + (ties - 1) / 2.0 ELSE 0 END),
        sum(CASE WHEN diff < 0 THEN low + (ties - 1) / 2.0 ELSE 0 END)) AS t,
  sum(CAST(ties AS DOUBLE) * ties - 1) AS tie_term FROM ranked),
normal AS (SELECT n, CAST(t AS DOUBLE) AS statistic, (t - n * (n + 1) / 4.0)
  / sqrt(CAST(n AS DOUBLE) * (n + 1) * (2 * n + 1) / 24 - tie_term / 48) AS z FROM mean_rank),""" + _normal_p(
    "z", "normal", "normal_p"
)


def _decisions(cte: str, permutations: int, digits: int) -> str:
    return f"""WITH {_permutation(cte, permutations)}, {RANKS}, {WALD}, {SIMPLE}, {NORMAL},
        results AS (SELECT 'permutation' AS test, statistic,
            CAST(n_above AS DOUBLE) / n_permutations AS p FROM perm_of
          UNION ALL SELECT 'wald', z, p FROM wald CROSS JOIN wald_p
          UNION ALL SELECT 'wilcoxon_simple', statistic, p FROM simple_p
          UNION ALL SELECT 'wilcoxon_normal', statistic, p FROM normal CROSS JOIN normal_p)
        SELECT test, round(statistic, {digits}) AS statistic, round(p, 6) AS p_value,
          CASE WHEN p <= 0.05 THEN 'Reject H0' ELSE 'Fail to Reject H0' END AS decision FROM results"""


# Eighths and quarters are exact as doubles, and so is every sum of them.
UNPAIRED = """pairs AS (SELECT entity_id, a.label AS actual, p.label AS predicted FROM
  (SELECT event_id AS entity_id, floor(value * 8) / 8 AS label FROM events WHERE event_id % 3 <> 0) a
  FULL JOIN (SELECT event_id AS entity_id, floor(value * 8) / 8 + (event_id % 5 - 2) / 4.0 AS label
    FROM events WHERE event_id % 3 <> 1) p USING (entity_id))"""


def _feature_matrix() -> str:
    psd = _psd(
        USER_SAMPLES + ",\nlast_block AS (SELECT entity_id, max(block) AS block FROM user_sample "
        "GROUP BY entity_id),\nlast_sample AS (SELECT s.* FROM user_sample s JOIN last_block USING "
        "(entity_id, block))",
        "last_sample", "entity_id, channel", v.USER_N_FFT, v.USER_FS,
    )
    wide = []
    for measure in ("mean", "std"):
        f = "avg" if measure == "mean" else "stddev_pop"
        wide += [
            f"(SELECT round({f}(value), 6) FROM user_sample s WHERE s.entity_id = m.entity_id "
            f"AND channel = '{ch}') AS {measure}_{ch}"
            for ch in c.CHANNELS
        ]
    for band, (low, high) in BAND_LIMITS.items():
        wide += [
            f"(SELECT round(avg(psd), 6) FROM psd_of p WHERE p.entity_id = m.entity_id AND "
            f"channel = '{ch}' AND frequency BETWEEN {low} AND {high}) AS {band}_{ch}"
            for ch in c.CHANNELS
        ]
    meta = ", ".join(
        f"CAST({f} AS DOUBLE) AS {f}"
        for f in ("age", "female", "male", "other", "rosc", "ohca", "vfib", "ttm")
    )
    return f"""WITH {FIELDS}, {psd},
quality_of AS (SELECT entity_id, CAST(sum(raw) % 100 AS DOUBLE) / 100 AS quality
  FROM last_sample GROUP BY entity_id)
SELECT entity_id, {meta}, {", ".join(wide)}, quality
FROM meta_of m LEFT JOIN quality_of USING (entity_id)"""


def _fixed_scores() -> tuple[str, str]:
    """The forward pass unit by unit and the trees split by split, as plain expressions.

    Gives the steps and the query of (entity_id, p, cpc) that follows them.
    """
    network, forest = c.fixed_models()
    inputs = ", ".join(
        f"(coalesce(CAST({n} AS DOUBLE), {f}) - ({m})) * {s} AS x{i}"
        for i, (n, f, m, s) in enumerate(zip(network.names, network.fill, network.shift, network.scale))
    )
    steps, source, name, wide = [f"inputs AS (SELECT entity_id, {inputs} FROM meta_of)"], "inputs", "x", len(network.names)
    for k, (weights, bias) in enumerate(network.layers):
        last = k == len(network.layers) - 1
        sums = [f"{b} + " + " + ".join(f"{name}{i} * ({w})" for i, w in enumerate(row)) for row, b in zip(weights, bias)]
        cells = ", ".join(f"{x if last else f'1 / (1 + exp(-({x})))'} AS h{k}_{j}" for j, x in enumerate(sums))
        keep = ", ".join(f"x{i}" for i in range(wide))
        steps.append(f"layer{k} AS (SELECT entity_id, {keep}, {cells} FROM {source})")
        source, name = f"layer{k}", f"h{k}_"

    def walk(tree) -> str:
        if isinstance(tree, float):
            return f"CAST({tree} AS DOUBLE)"
        at, cut, low, high = tree
        return f"CASE WHEN x{at} <= {cut} THEN {walk(low)} ELSE {walk(high)} END"

    cpc = " + ".join(f"{w} * ({walk(t)})" for w, t in forest.trees)
    last = f"SELECT entity_id, exp({name}1) / (exp({name}0) + exp({name}1)) AS p, {cpc} AS cpc FROM {source}"
    return ", ".join(steps), last


def _shown(failed: str) -> str:
    return f"""CASE WHEN {failed} THEN 0.0::DOUBLE WHEN p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS predicted_outcome,
        CASE WHEN {failed} THEN 0.0 ELSE round(p, 6) END AS poor_probability,
        CASE WHEN {failed} THEN 0.0 ELSE round(least(5.0, greatest(1.0, cpc)), 6) END AS predicted_cpc"""


def _score_fixed() -> str:
    steps, last = _fixed_scores()
    return f"""WITH {FIELDS}, {INDEX}, {ORDER_SAMPLES}, {steps}, raw_score AS ({last}),
      failed_of AS (SELECT DISTINCT entity_id FROM index_of i WHERE record_id IS NOT NULL AND NOT EXISTS
        (SELECT 1 FROM order_sample s WHERE s.entity_id = i.entity_id AND s.record_id = i.record_id)),
      scored AS (SELECT *, entity_id IN (SELECT entity_id FROM failed_of) AS failed FROM raw_score)
      SELECT entity_id, {_shown("failed")}, failed FROM scored"""


def _score_failures() -> str:
    """The first of three steps in which an entity fails; a checksum is wrong for every 41st order."""
    steps, last = _fixed_scores()
    return f"""WITH {FIELDS}, {INDEX}, {ORDER_SAMPLES}, {steps}, raw_score AS ({last}),
      named AS (SELECT DISTINCT entity_id, record_id FROM index_of WHERE record_id IS NOT NULL),
      no_text AS (SELECT entity_id, 1::BIGINT AS n FROM raw_score WHERE CAST(entity_id AS BIGINT) % 13 = 0),
      lost AS (SELECT entity_id, count(*) AS n FROM named i WHERE NOT EXISTS
        (SELECT 1 FROM order_sample s WHERE s.entity_id = i.entity_id AND s.record_id = i.record_id) GROUP BY entity_id),
      wrong AS (SELECT entity_id, count(*) AS n FROM (SELECT DISTINCT entity_id, record_id, channel FROM order_sample
        JOIN named USING (entity_id, record_id) WHERE CAST(record_id AS BIGINT) % 41 = 0) GROUP BY entity_id),
      told AS (SELECT r.*, t.n AS n1, l.n AS n2, w.n AS n3, coalesce(t.n, l.n, w.n) AS n FROM raw_score r
        LEFT JOIN no_text t USING (entity_id) LEFT JOIN lost l USING (entity_id) LEFT JOIN wrong w USING (entity_id))
      SELECT entity_id, {_shown("n IS NOT NULL")},
        CASE WHEN n1 > 0 THEN 'text' WHEN n2 > 0 THEN 'recordings' WHEN n3 > 0 THEN 'signals' END AS step,
        CASE WHEN n1 > 0 THEN 'no text' WHEN n2 > 0 THEN 'recording not stored'
          WHEN n3 > 0 THEN 'header and samples differ' END AS reason, n FROM told"""


def oracle_sql() -> dict[str, str]:
    series = "entity_id, record_id, channel"
    psd = _psd(SAMPLES, "sample_of", series, v.SAMPLE_N_FFT, v.SAMPLE_FS)
    last_psd = _psd(
        SAMPLES + ", last_of AS (SELECT entity_id, max(record_id) AS record_id FROM sample_of "
        "GROUP BY entity_id), last_sample AS (SELECT s.* FROM sample_of s JOIN last_of "
        "USING (entity_id, record_id))",
        "last_sample", "entity_id, channel", v.SAMPLE_N_FFT, v.SAMPLE_FS,
    )
    vectors = """
vec AS (SELECT vec_id AS entity_id, unnest(range(len(embedding))) AS idx,
  CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings)"""
    array_psd = _psd(vectors, "vec", "entity_id", v.SAMPLE_N_FFT, v.SAMPLE_FS)
    signature_text = """SELECT entity_id, string_agg(CAST(h AS VARCHAR), ',' ORDER BY i) AS signature
  FROM mh GROUP BY entity_id"""
    imputed = ", ".join(
        f"round(coalesce(CAST({f} AS DOUBLE), avg({f}) OVER ()), 6) AS {f}"
        for f in ("age", "female", "male", "other", "rosc", "ohca", "vfib", "ttm")
    )
    logit = " + ".join(
        f"coalesce({f}, 0) * {w}" for f, w in zip(c.SCORE_FIELDS, c.SCORE_WEIGHTS)
    )
    sqls = {
        "list_entities": f"WITH {ENTITY_TEXT} SELECT DISTINCT entity_id FROM text_of ORDER BY 1",
        "list_entity_folders": f"WITH {ENTITY_TEXT} SELECT DISTINCT entity_id FROM text_of",
        "read_entity_text": f"WITH {ENTITY_TEXT} SELECT entity_id, text FROM text_of",
        "read_recording_index": f"WITH {INDEX} SELECT * FROM index_of",
        "parse_record_headers": f"""WITH {SPEC} SELECT s.entity_id, s.record_id,
            concat(s.entity_id, '_', s.record_id) AS record_name, n_channels AS num_signals,
            64.0::DOUBLE AS sampling_frequency, longest AS num_samples,
            CAST(row_number() OVER (PARTITION BY s.entity_id, s.record_id ORDER BY channel) - 1
              AS INTEGER) AS position,
            signal_file, 50.0::DOUBLE AS gain,
            10::BIGINT AS adc_offset, initial_value, CAST(checksum AS BIGINT) AS checksum, channel
            FROM spec_of s JOIN longest_of l ON s.entity_id = l.entity_id AND s.record_id = l.record_id""",
        "assemble_entities": f"""WITH {ENTITY_TEXT}, {INDEX}, {ORDER_SAMPLES},
            stored AS (SELECT entity_id, record_id, count(DISTINCT channel) AS n_channels,
              count(*) AS n_samples FROM order_sample GROUP BY entity_id, record_id)
            SELECT t.entity_id, i.seq, i.record_id, n_channels, n_samples, text FROM text_of t
            LEFT JOIN index_of i ON i.entity_id = t.entity_id
            LEFT JOIN stored s ON s.entity_id = i.entity_id AND s.record_id = i.record_id""",
        "entity_recordings": f"""WITH {SPEC} SELECT entity_id, record_id AS seq, record_id,
            CAST(64 AS DOUBLE) AS sampling_frequency, channels, longest AS num_samples
            FROM longest_of JOIN (SELECT entity_id, record_id, string_agg(channel, ',' ORDER BY channel) AS channels
              FROM spec_of GROUP BY entity_id, record_id) USING (entity_id, record_id)
            UNION ALL SELECT DISTINCT entity_id, 9, CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE), NULL, CAST(NULL AS BIGINT)
            FROM sample_of""",
        "entity_signals": f"""WITH {SPEC}, line_of AS (SELECT entity_id, record_id, channel,
              CAST(row_number() OVER (PARTITION BY entity_id, record_id ORDER BY channel) - 1 AS INTEGER) AS position
              FROM spec_of)
            SELECT entity_id, record_id AS seq, record_id, channel, position, CAST(idx // 32 AS BIGINT) AS chunk,
              CAST(idx // 32 * 32 AS BIGINT) AS "start", string_agg(CAST(raw AS VARCHAR), ',' ORDER BY idx) AS samples
            FROM sample_of JOIN line_of USING (entity_id, record_id, channel)
            GROUP BY entity_id, record_id, channel, position, idx // 32""",
        "signal_chunks": f"""WITH {SAMPLES} SELECT entity_id, record_id, channel, CAST(idx // 20 AS BIGINT) AS chunk,
            CAST(idx // 20 * 20 AS BIGINT) AS "start", string_agg(CAST(raw AS VARCHAR), ',' ORDER BY idx) AS samples
            FROM sample_of GROUP BY entity_id, record_id, channel, idx // 20""",
        "recording_states": """WITH v AS (SELECT label AS entity_id, CAST(vec_id % 3 AS INTEGER) AS record_id, vec_id,
              unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
            SELECT entity_id, record_id, 'vector' AS channel, count(*) AS n, round(avg(x), 6) AS mean,
              round(stddev_pop(x), 6) AS std, CAST(0 AS BIGINT) AS first_at,
              round(arg_min(x, vec_id) FILTER (i = 0), 6) AS "first", round(sum(x), 4) AS total
            FROM v GROUP BY entity_id, record_id""",
        "orphan_recordings": f"""WITH {INDEX}, {ORDER_SAMPLES} SELECT DISTINCT entity_id, record_id
            FROM index_of i WHERE record_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM order_sample s
              WHERE s.entity_id = i.entity_id AND s.record_id = i.record_id)""",
        "load_labels": f"""WITH {FIELDS} SELECT entity_id, patient,
            CASE outcome WHEN 'Good' THEN 0 WHEN 'Poor' THEN 1 END AS outcome, cpc FROM field_of""",
        "read_label_map": """SELECT CAST(doc_id AS VARCHAR) AS entity_id,
            CASE WHEN doc_id % 17 = 0 THEN 1.0 WHEN doc_id % 19 = 0 THEN NULL
                 ELSE CAST(quality AS DOUBLE) END AS label
            FROM labels WHERE doc_id % 11 <> 0 AND doc_id % 13 <> 0""",
        "parse_entity_fields": f"WITH {FIELDS} SELECT * FROM field_of",
        "recording_columns": """SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, 0 AS seq,
            CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderkey % 72 AS DOUBLE) END AS hour,
            '12:30' AS "time", round(CAST(o_orderkey % 100 AS DOUBLE) / 100, 6) AS quality,
            CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS record_id FROM orders""",
        **{f"cast_{k}": _cast(k) for k in ("bool", "int", "float", "string")},
        "classify_values": f"WITH {CELLS} SELECT cell_id, {_classes('raw')} FROM cell",
        "classify_words": f"""WITH word_of AS (
            SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents),
            flags AS (SELECT doc_id, {_classes('word')} FROM word_of)
            SELECT doc_id, count(*) AS words, count(*) FILTER (is_number) AS is_number,
              count(*) FILTER (is_integer) AS is_integer, count(*) FILTER (is_boolean) AS is_boolean,
              count(*) FILTER (is_finite_number) AS is_finite_number,
              count(*) FILTER (is_nan) AS is_nan FROM flags GROUP BY doc_id""",
        "strip_markup": f"WITH {CELLS} SELECT cell_id, {_markup('raw')} AS stripped FROM cell",
        "encode_outcome": """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS entity_id,
            CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS outcome FROM customer""",
        "one_hot_sex": f"WITH {FIELDS} SELECT entity_id, female, male, other FROM meta_of",
        "clip_score": """SELECT event_id,
            round(CASE WHEN value / 20 < 1 THEN 1 WHEN value / 20 > 5 THEN 5 ELSE value / 20 END, 6)
            AS score FROM events""",
        "score_threshold": """SELECT event_id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS predicted,
            round(p, 6) AS p, round(1 - p, 6) AS complement
            FROM (SELECT event_id, 1 / (1 + exp(-(value - 50) / 25)) AS p FROM events) t""",
        "truncate_by_hour": f"""WITH {INDEX} SELECT entity_id, seq, hour, quality, record_id
            FROM index_of WHERE hour <= {c.HOUR_LIMIT}""",
        "latest_recording": f"""WITH {INDEX} SELECT entity_id, seq, record_id, hour, quality FROM (
            SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY seq DESC) AS back
            FROM index_of WHERE record_id IS NOT NULL) t WHERE back = 1""",
        "skip_first_recordings": f"""WITH {INDEX} SELECT entity_id, seq, record_id FROM (
            SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY seq) AS slot FROM index_of) t
            WHERE slot > 4 AND record_id IS NOT NULL""",
        "truncate_cohort": f"""WITH {INDEX}, {ORDER_SAMPLES} SELECT * FROM order_sample s WHERE EXISTS (
            SELECT 1 FROM index_of i WHERE i.hour <= {c.HOUR_LIMIT} AND i.entity_id = s.entity_id
              AND i.record_id = s.record_id)""",
        "truncate_cohort_tables": f"""WITH {INDEX}, {ORDER_SAMPLES} SELECT i.entity_id, i.seq, i.record_id,
            i.hour, nullif((SELECT count(*) FROM order_sample s WHERE s.entity_id = i.entity_id
              AND s.record_id = i.record_id), 0) AS n_samples FROM index_of i
            WHERE i.hour <= {c.HOUR_LIMIT}""",
        "sample_entities": f"WITH {TARGETS} SELECT entity_id FROM tgt",
        "split_targets": f"""WITH {TARGETS} SELECT doc_id AS entity_id, CASE WHEN doc_id IN
            (SELECT entity_id FROM tgt) THEN 'target' ELSE 'check' END AS side FROM documents""",
        "rescale_signal": f"""WITH {SAMPLES} SELECT {series}, idx, round(value, 6) AS value
            FROM sample_of""",
        "rescale_array": f"""WITH {vectors} SELECT entity_id, CAST(idx AS INTEGER) AS idx,
            round(CAST(CAST((value - 1) / 0.25 AS FLOAT) AS DOUBLE), 4) AS value FROM vec""",
        "select_channels": f"""WITH {SAMPLES},
            wanted AS (SELECT * FROM (VALUES {', '.join(f"('{t}', {i})" for i, t in enumerate(c.TARGET_CHANNELS))})
              w(channel, position)),
            slots AS (SELECT DISTINCT entity_id, record_id, w.channel, position FROM sample_of
              CROSS JOIN wanted w)
            SELECT entity_id, record_id, CAST(position AS INTEGER) AS position, channel, idx, raw
            FROM slots LEFT JOIN sample_of USING (entity_id, record_id, channel)""",
        "channel_stats": f"""WITH {SAMPLES} SELECT entity_id, channel, count(*) AS n_samples,
            round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std
            FROM sample_of GROUP BY entity_id, channel""",
        "signal_quality_report": f"""WITH {SPEC} SELECT s.entity_id, s.record_id, channel,
            n_files = 1 AS one_file_ok, num_samples = longest AS shape_ok,
            first_raw = initial_value AS initial_ok,
            total = checksum AS checksum_ok
            FROM spec_of s JOIN longest_of l ON s.entity_id = l.entity_id AND s.record_id = l.record_id""",
        "concat_recordings": f"""WITH {SAMPLES} SELECT entity_id, channel,
            row_number() OVER (PARTITION BY entity_id, channel ORDER BY record_id, idx) - 1 AS position,
            round(value, 6) AS value FROM sample_of""",
        "signal_shingles": f"""WITH {SHINGLES_OF_SIGNALS} SELECT entity_id, shingle FROM sh s
            WHERE record_id > (SELECT min(record_id) FROM sh o WHERE o.entity_id = s.entity_id)""",
        "signal_signature": f"WITH {_signature(SHINGLES_OF_SIGNALS, 'sh')} {signature_text}",
        "welch_psd": f"""WITH {psd} SELECT {series}, bin, frequency, round(psd, 6) AS psd FROM psd_of""",
        "welch_psd_arrays": f"""WITH {array_psd} SELECT entity_id, bin, frequency, round(psd, 8) AS psd
            FROM psd_of""",
        "band_power": f"""WITH {last_psd} SELECT entity_id, channel, {_band_columns()}
            FROM psd_of GROUP BY entity_id, channel""",
        "band_power_fine": f"""WITH {_psd(vectors, "vec", "entity_id", 32, 64.0)}
            SELECT entity_id, {_band_columns(8)} FROM psd_of GROUP BY entity_id""",
        "fit_cpc_linear": """WITH p AS (SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) / 1000 AS price,
              CASE WHEN o_custkey % 3 > 0 THEN 1 + o_custkey % 5 + CAST(o_totalprice AS DOUBLE) / 100000 END AS cpc
              FROM orders),
            line AS (SELECT regr_slope(cpc, price) AS a, regr_intercept(cpc, price) AS b FROM p)
            SELECT o_orderkey AS entity_id, round(a * price + b, 4) AS cpc_raw FROM p CROSS JOIN line""",
        "score_properties": f"""WITH {INDEX}, {ORDER_SAMPLES}, failed AS (SELECT DISTINCT entity_id
              FROM index_of i WHERE record_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM order_sample s
              WHERE s.entity_id = i.entity_id AND s.record_id = i.record_id))
            SELECT count(*) AS n, count(*) AS n_entities,
              (SELECT count(*) FROM failed SEMI JOIN (SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS entity_id
                FROM customer) USING (entity_id)) AS n_failed,
              CAST(0 AS BIGINT) AS scored_failed, CAST(0 AS BIGINT) AS unscored,
              CAST(0 AS BIGINT) AS out_of_range, CAST(0 AS BIGINT) AS wrong_class FROM customer""",
        "minhash_signature": f"WITH {SIGNATURES} {signature_text}",
        "lsh_bands": f"WITH {BAND_ROWS} SELECT entity_id, band, band_key FROM band_of",
        "lsh_candidates": f"WITH {SCORED} SELECT target_id, check_id FROM cand",
        "signature_jaccard": f"""WITH {SCORED} SELECT target_id, check_id,
            round(similarity, 6) AS similarity FROM scored""",
        "similar_entities": f"""WITH {SCORED} SELECT target_id, check_id,
            round(similarity, 6) AS similarity FROM scored WHERE similarity > 0.8""",
        "similar_entities_full_size": f"""WITH {FULL_SIZE} SELECT target_id, check_id,
            round(similarity, 6) AS similarity FROM scored WHERE similarity > 0.8""",
        "similar_one_per_target": f"""WITH {SCORED} SELECT target_id, check_id,
            round(similarity, 6) AS similarity FROM (SELECT *, row_number() OVER (
              PARTITION BY target_id ORDER BY similarity DESC, check_id) AS place FROM scored
              WHERE similarity > 0.8) t WHERE place = 1""",
        "pair_labels": f"WITH {LABELS} SELECT entity_id, actual, predicted FROM pairs",
        "label_map": """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS entity_id,
            CASE WHEN c_acctbal < 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM customer""",
        "label_map_scores": """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS entity_id,
            CAST(1 + c_custkey % 5 AS DOUBLE) AS label FROM customer""",
        "classification_metrics": f"""WITH {LABELS}, t AS (SELECT count(*) AS n,
            avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END) AS accuracy,
            sum(actual * predicted) AS tp, sum(actual) AS pos, sum(predicted) AS called FROM pairs)
            SELECT n, round(accuracy, 6) AS accuracy,
              round(CASE WHEN pos + called = 0 THEN 0 ELSE 2.0 * tp / (pos + called) END, 6) AS f1 FROM t""",
        "regression_metrics": f"""WITH {PAIRS} SELECT count(*) AS n,
            round(avg(CAST((actual - predicted) * (actual - predicted) AS DOUBLE)), 6) AS mse,
            round(avg(CAST(abs(actual - predicted) AS DOUBLE)), 6) AS mae FROM pairs""",
        "evaluation_report": """WITH t AS (SELECT quality AS o, toxic AS po, 1 + n_chars % 5 AS s,
              CASE WHEN n_chars % 70 / 10.0 < 1 THEN 1.0 WHEN n_chars % 70 / 10.0 > 5 THEN 5.0
                   ELSE n_chars % 70 / 10.0 END AS ps
              FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
            SELECT round(avg(CASE WHEN o = po THEN 1.0 ELSE 0.0 END), 3) AS outcome_accuracy,
              round(2.0 * sum(o * po) / (sum(o) + sum(po)), 3) AS outcome_f1,
              round(avg(CAST((s - ps) * (s - ps) AS DOUBLE)), 3) AS cpc_mse,
              round(avg(CAST(abs(s - ps) AS DOUBLE)), 3) AS cpc_mae FROM t""",
        "signed_ranks": f"""WITH {PAIRS}, {RANKS} SELECT entity_id, diff,
            CASE WHEN diff > 0 THEN low ELSE -low END AS signed_rank FROM ranked""",
        "permutation_test": f"WITH {_permutation(LABELS, 1000)} {PERMUTATION_COLUMNS}",
        "permutation_test_close": "WITH "
        + _permutation(
            "pairs AS (SELECT doc_id AS entity_id, 1 - quality AS actual, toxic AS predicted FROM labels)",
            1000,
        )
        + PERMUTATION_COLUMNS,
        "permutation_draws": """SELECT count(quality) AS n_x, count(toxic) AS n_y, CAST(1000 AS BIGINT) AS n_permutations,
            round(abs(avg(1 - quality) - avg(toxic)), 6) AS statistic, TRUE AS p_agrees FROM labels""",
        "wald_test": f"""WITH {PAIRS}, {WALD} SELECT round(z, 6) AS statistic, round(p, 6) AS p_value
            FROM wald CROSS JOIN wald_p""",
        "wilcoxon_simple": f"""WITH {PAIRS}, {RANKS}, {SIMPLE} SELECT n, statistic,
            round(p, 9) AS p_value FROM simple_p""",
        "wilcoxon_normal": f"""WITH {PAIRS}, {RANKS}, {NORMAL} SELECT n, statistic, round(z, 6) AS z,
            round(p, 6) AS p_value FROM normal CROSS JOIN normal_p""",
        "test_decisions": _decisions(LABELS, 1000, 6),
        "compare_unpaired": _decisions(UNPAIRED, 1000, 4),
        "feature_matrix": _feature_matrix(),
        "feature_matrix_pieces": _feature_matrix(),
        "label_object": """SELECT concat('doc,"', CAST(doc_id AS VARCHAR), chr(92), '"') AS entity_id,
            max(CAST(quality AS DOUBLE)) AS label FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
            HAVING max(quality) IS NOT NULL""",
        "score_fixed": _score_fixed(),
        "score_failures": _score_failures(),
        "mean_impute": f"WITH {FIELDS} SELECT entity_id, {imputed} FROM meta_of",
        "linear_score": f"""WITH {FIELDS}, s AS (SELECT entity_id, {logit} + ({c.SCORE_BIAS}) AS x FROM meta_of)
            SELECT entity_id, round(1 / (1 + exp(-x)), 6) AS probability,
              CASE WHEN x > 0 THEN 1 ELSE 0 END AS predicted,
              round(least(5.0, greatest(1.0, x)), 6) AS score FROM s""",
    }
    return {name: " ".join(sql.split("\n")) for name, sql in sqls.items()}
