"""The registered queries of this subpackage, each over its whole table, and their SQL where there is any."""

import string
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from dwellmart.llm import (
    conversation_repair,
    digest_index,
    embedding_forest,
    license_scan,
    mixing,
    packing,
    ppm,
    quality,
    simhash,
    spelling_variants,
    token_counts,
    toxicity,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it was not sent with ``--py-files``."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join(filter(None, [*paths, _ROOT]))


def registered(query):
    @wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        importable(spark)
        return query(spark, sf)

    QUERIES[query.__name__] = run
    return run


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


@registered
def op6_simhash_vantage_trees(spark, sf):
    return simhash.near_duplicates(read(spark, sf, "documents"))


@registered
def op8_mixing_blocks(spark, sf):
    return mixing.taken_words(read(spark, sf, "documents"))


def _rounds() -> str:
    """The rounds of the permutation, one step for each."""
    steps = []
    for r in range(mixing.ROUNDS):
        of, to, size = ("l", "r", "b") if r % 2 else ("r", "l", "a")
        shift = f"('0x' || substr(md5('42-' || number || ':{r}:' || {of}), 1, 8))::BIGINT"
        steps.append(f"round_{r + 1} AS (SELECT * REPLACE (({to} + {shift}) % {size} AS {to}) FROM round_{r}),")
    return "\n".join([*steps, f"permutation AS (SELECT source, x, l * b + r AS y, whole FROM round_{mixing.ROUNDS}),"])


ORACLES["op8_mixing_blocks"] = """
WITH RECURSIVE sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
numbered AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM sources),
weighted AS (SELECT *, [5, 2, 1][number % 3 + 1] AS weight, 3 * source_size AS cap FROM numbered),
ranked AS (SELECT *, row_number() OVER (ORDER BY cap / weight, number) AS place FROM weighted),
levels AS (
    SELECT *,
        ((sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0))::BIGINT
            / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0))::BIGINT) AS level
    FROM ranked WINDOW earlier AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
leveled AS (SELECT *, min_by(level, place) FILTER (level <= cap / weight) OVER () AS open_level FROM levels),
plan AS (
    SELECT source, number, source_size,
        CASE WHEN level > cap / weight THEN cap::DOUBLE ELSE open_level * weight END AS target
    FROM leveled
),
cut AS (
    SELECT *, floor(target)::BIGINT // source_size AS passes, floor(target)::BIGINT % source_size AS rest,
        source_size // 1024 AS whole, (source_size + 1023) // 1024 AS blocks
    FROM plan WHERE source_size > 0
),
slots AS (
    SELECT *, slot // blocks AS pass, slot % blocks AS k
    FROM (SELECT *, unnest(range(passes * blocks + (rest + 1023) // 1024)) AS slot FROM cut)
),
table_of AS (SELECT source, number, whole, a, (whole + a - 1) // a AS b
    FROM (SELECT *, ceil(sqrt(whole))::BIGINT AS a FROM cut WHERE whole > 0)),
round_0 AS (SELECT *, x // b AS l, x % b AS r FROM (SELECT *, unnest(range(a * b)) AS x FROM table_of)),
@ROUNDS@
walk AS (
    SELECT source, x AS k, y, whole FROM permutation WHERE x < whole
    UNION ALL
    SELECT w.source, w.k, p.y, w.whole FROM walk w JOIN permutation p ON w.source IS NOT DISTINCT FROM p.source AND w.y = p.x
    WHERE w.y >= w.whole
),
takes AS (
    SELECT s.source, CASE WHEN s.k < s.whole THEN w.y ELSE s.whole END AS block,
        least(1024, source_size - s.k * 1024, CASE WHEN pass < passes THEN 1024 ELSE rest - s.k * 1024 END) AS take
    FROM slots s LEFT JOIN walk w ON s.source IS NOT DISTINCT FROM w.source AND s.k = w.k AND w.y < w.whole
),
spans AS (
    SELECT doc_id, source, size, coalesce(sum(size) OVER (
        PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
    ), 0)::BIGINT AS start
    FROM sized
),
parts AS (
    SELECT doc_id, source, size, start, unnest(range(start // 1024, (start + size - 1) // 1024 + 1)) AS block
    FROM spans WHERE size > 0
),
taken AS (
    SELECT doc_id, sum(greatest(0,
        least(start + size, p.block * 1024 + take) - greatest(start, p.block * 1024)))::BIGINT AS words
    FROM parts p JOIN takes t ON p.source IS NOT DISTINCT FROM t.source AND p.block = t.block GROUP BY doc_id
)
SELECT s.doc_id, s.size, p.source_size, p.target, coalesce(t.words, 0)::BIGINT AS taken
FROM spans s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source LEFT JOIN taken t ON s.doc_id = t.doc_id
""".replace("@ROUNDS@", _rounds())


@registered
def op9_quality_votes(spark, sf):
    return quality.judge(read(spark, sf, "documents"))


@registered
def op10_packing_windows(spark, sf):
    return packing.pack(read(spark, sf, "documents"))


@registered
def op5_toxicity_ftrl(spark, sf):
    return toxicity.scored(read(spark, sf, "documents"), read(spark, sf, "labels"))


@registered
def op7_url_shift_and(spark, sf):
    return url_filter.judged(read(spark, sf, "pages"))


def _like(glob: str) -> str:
    escaped = glob.replace("!", "!!").replace("%", "!%").replace("_", "!_").replace("*", "%").replace("'", "''")
    return f"canonical LIKE '{escaped}' ESCAPE '!'"


_FITS = " ".join(
    f"WHEN {_like(f'*.{host}?{path}*')} THEN ['{host}{path}', '{verdict}']"
    for verdict, host, path in sorted(url_filter.BASE_RULES, key=lambda rule: -len(rule[1] + rule[2]))
)
ORACLES["op7_url_shift_and"] = f"""
WITH rests AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests
),
texts AS (SELECT *, '.' || host || '?' || path AS canonical FROM parts),
fits AS (SELECT *, CASE {_FITS} END AS fit FROM texts)
SELECT page_id, host, path, fit[1] AS rule, coalesce(fit[2],
    CASE WHEN {' OR '.join(map(_like, url_filter.BLOCK_GLOBS))} THEN 'block' ELSE 'allow' END) AS verdict
FROM fits
"""


@registered
def op3_license_signatures(spark, sf):
    return license_scan.scanned(read(spark, sf, "documents"))


@registered
def op4_ppm_scores(spark, sf):
    return ppm.scored(read(spark, sf, "documents"))


@registered
def op2_token_counts_trie(spark, sf):
    return token_counts.counted(read(spark, sf, "documents"))


@registered
def op1_embedding_forest(spark, sf):
    return embedding_forest.near_duplicates(read(spark, sf, "embeddings"))


@registered
def op11_spelling_trie(spark, sf):
    words = spelling_variants.counted_words(read(spark, sf, "documents"), every=199)
    return spelling_variants.variants(words)


@registered
def op12_conversation_repair(spark, sf):
    conversations = read(spark, sf, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(conversations), conversations)


@registered
def op13_digest_index(spark, sf):
    return digest_index.deduplicated(read(spark, sf, "documents"))


ORACLES["op13_digest_index"] = """
WITH rows AS (
    SELECT doc_id, length(coalesce(text, '')) AS length,
        sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER best = 1 AS kept, text_sha256
FROM rows WINDOW best AS (PARTITION BY text_sha256 ORDER BY length DESC, doc_id)
"""


ORACLES["op1_embedding_forest"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reach AS (
    SELECT vec_id, vec_id AS other FROM usable
    UNION
    SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
),
components AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, v.vec_id) AS component_id,
    v.vec_id = coalesce(component_id, v.vec_id) AS kept
FROM embeddings v LEFT JOIN components USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

#: crc32 by its rule: the table of its 256 steps, and a fold over the bytes of a hexadecimal text.
_CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
)"""


def _crc32(hexadecimal: str) -> str:
    byte = f"('0x' || substr({hexadecimal}, 2 * i + 1, 2))::BIGINT"
    all_bytes = f"list_transform(range(len({hexadecimal}) // 2), lambda i: {byte})"
    step = "xor(c >> 8, steps[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {all_bytes}), lambda c, b: {step}), 4294967295)"


ORACLES["op11_spelling_trie"] = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
        '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run FROM documents
),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
    SELECT *, {_crc32("bytes")} AS h
    FROM (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes FROM counted), crc_table
),
damaged AS (
    SELECT n, CASE WHEN h % 199 = 0
        THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed
),
words AS (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holes AS (
    SELECT word, n, place, left(word, place - 1) || substr(word, place + 1) AS less
    FROM (SELECT *, unnest(range(1, length(word) + 1)) AS place FROM words)
),
shorter AS (SELECT DISTINCT h.word AS a, h.n AS a_n, w.word AS b, w.n AS b_n FROM holes h JOIN words w ON h.less = w.word),
near AS (
    SELECT a AS word, b AS near, b_n AS near_n FROM shorter UNION ALL SELECT b, a, a_n FROM shorter UNION ALL
    SELECT x.word, y.word, y.n FROM holes x JOIN holes y ON x.place = y.place AND x.less = y.less AND x.word <> y.word
),
best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM near GROUP BY word
),
formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
),
way AS (
    SELECT word, word AS root, form AS further FROM formed
    UNION ALL SELECT y.word, y.further, f.form FROM way y JOIN formed f ON y.further = f.word
)
SELECT f.word, f.form, y.root, f.n, f.n_near, f.form_n FROM formed f JOIN way y ON f.word = y.word AND y.further IS NULL
"""


def _edited(state: str, cost: str, edit: str, line: str | None) -> str:
    """A state (cost, audit, text so far) after one more edit."""
    text = f"substr({state}, strpos({state}, chr(1)) + 1)"
    more = "" if line is None else f" || CASE WHEN {text} = '' THEN '' ELSE chr(10) END || {line}"
    return (
        f"lpad((substr({state}, 1, 8)::BIGINT + {cost})::VARCHAR, 8, '0') || "
        f"substr(split_part({state}, chr(1), 1), 9) || '{edit}' || chr(1) || {text}{more}"
    )


def _put_in(source: str) -> str:
    """Two rounds of turns put in, before any turn or the end. u, a, s, e: what comes last, e for nothing."""
    for _ in range(2):
        user = ", ".join(_edited(state, "5", "I", "'user:'") for state in ("e", "s", "a"))
        assistant = _edited("u", "5", "I", "'assistant:'")
        source = f"(SELECT * REPLACE (least(u, {user}) AS u, least(a, {assistant}) AS a) FROM {source})"
    return source


def _stays(state: str, initial: str, role: str) -> str:
    """A turn after ``state`` that is kept as it is or given the role that is due."""
    kept = f"CASE WHEN initial = '{initial}' THEN {_edited(state, 'late', 'K', 'line')} END"
    given = _edited(state, "late + 1", "R", f"'{role}:' || text")
    return f"CASE WHEN NOT must_go THEN least({kept}, {given}) END"


_DELETED = {state: _edited(state, "2", "D", None) for state in "esua"}
ORACLES["op12_conversation_repair"] = f"""
WITH RECURSIVE {_CRC_TABLE},
hashed AS (
    SELECT *, {_crc32("bytes")} % 20 AS fault FROM (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS bytes FROM conversations
    ), crc_table
),
turns AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
    FROM turns
),
kinds AS (
    SELECT *, left(role, 1) AS initial, role || ':' || text AS line,
        CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE 'fine' END AS kind,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS initial_before
    FROM numbered
),
costs AS (
    SELECT conv_id, place, initial, line, text, kind IN ('blank', 'duplicate') AS must_go,
        CASE WHEN kind = 'truncated' THEN 5 ELSE 0 END AS late FROM kinds
),
ids AS (SELECT DISTINCT conv_id FROM conversations),
steps AS (
    SELECT conv_id, 0::BIGINT AS place, '00000000' || chr(1) AS e, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM ids
    UNION ALL
    SELECT p.conv_id, c.place, {_DELETED['e']} AS e,
        least({_DELETED['s']}, CASE WHEN NOT must_go AND initial = 's' THEN {_edited('e', 'late', 'K', 'line')} END) AS s,
        least({_DELETED['u']}, {', '.join(_stays(state, 'u', 'user') for state in 'esa')}) AS u,
        least({_DELETED['a']}, {_stays('u', 'a', 'assistant')}) AS a
    FROM {_put_in('steps')} p JOIN costs c ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND c.place = p.place + 1
),
last_steps AS (SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY place DESC) = 1),
ends AS (SELECT conv_id, least(e, a) AS found FROM {_put_in('last_steps')}),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'duplicate') AS duplicate,
        count(*) FILTER (kind = 'truncated') AS truncated,
        count(*) FILTER (initial_before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM kinds GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, substr(found, 1, 8)::BIGINT AS cost,
    substr(split_part(found, chr(1), 1), 9) AS audit, sha256(substr(found, strpos(found, chr(1)) + 1)) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
