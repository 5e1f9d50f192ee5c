"""The registered query of each operator: thin, over whole tables, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers as tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.llm import classes, dialogue, licenses, merkle, pii, rules as quality, secrets
from shelfline.llm.byte_bpe import decode, encode
from shelfline.llm.minhash import near_duplicates
from shelfline.llm.positions import contamination
from shelfline.llm.substrings import remove_repeats
from shelfline.llm.token_files import read_token_files, write_token_files
from shelfline.llm.toxicity import score, train
from shelfline.session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    """Register a query under its own name."""
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_near_duplicates(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80)


@query
def op3_token_files(spark, sf_dir):
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    parts = write_token_files(_table(spark, sf_dir, "documents"), folder, tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, folder, parts).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op5_substrings(spark, sf_dir):
    return remove_repeats(_table(spark, sf_dir, "documents"), window=20).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op9_byte_bpe(spark, sf_dir):
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path, tokenizers.PATTERN)
    return decode(encoded.drop("text"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def _remainder(of: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of))


@query
def op2_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(_remainder(4) != 2).select("doc_id", F.col("toxic").alias("label"))
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (_remainder(4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_decontamination(spark, sf_dir):
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op10_class_scores(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = classes.score(docs, _remainder(5) != 1)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op6_quality_rules(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    rules = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs.select("doc_id", "text"), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op8_personal_data(spark, sf_dir):
    found = pii.find(_table(spark, sf_dir, "documents"))
    counts = {f"n_{kind}": F.size(F.filter("base", _is(kind))).cast("long") for kind in pii.KINDS}
    return found.withColumns(counts).select("doc_id", *counts, F.sha2(pii.told(F.col("base")), 256).alias("base_sha256"),
                                            pii.told(F.col("spans")).alias("spans"))


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


@query
def op4_licenses(spark, sf_dir):
    found = licenses.scan(_table(spark, sf_dir, "documents"), licenses.known_notices(spark), licenses.known_texts(spark))
    return found.select("doc_id", F.coalesce("whole_license", F.lit("")).alias("whole_license"),
                        F.array_join("licenses", ",").alias("licenses"))


def _plain_sql(text: str) -> str:
    out = f"(' ' || regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' ')"
    for old, new in licenses.EQUIVALENTS:
        out = f"replace({out}, ' {old} ', ' {new} ')"
    return f"trim({out})"


def _lines_sql(text: str) -> str:
    kept = f"list_filter(string_split(coalesce({text}, ''), chr(10)), lambda x: NOT regexp_matches(lower(x), '{licenses.COPYRIGHT}'))"
    return f"list_filter(list_transform({kept}, lambda x: {_plain_sql('x')}), lambda x: x <> '')"


_NOTICES_SQL = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.NOTICES)
ORACLES["op4_licenses"] = f"""
WITH known AS (SELECT DISTINCT license, regexp_replace(array_to_string({_lines_sql("text")}, ' '), ' +', ' ', 'g') AS t
               FROM (VALUES {_NOTICES_SQL}) AS v(license, text)),
lines AS (SELECT doc_id, {_lines_sql("text")} AS l FROM documents),
units AS (SELECT doc_id, true AS w, array_to_string(l, ' ') AS t FROM lines
          UNION ALL SELECT doc_id, false, unnest(l) FROM lines),
found AS (SELECT u.doc_id, u.w, k.license FROM units u JOIN known k ON regexp_replace(u.t, ' +', ' ', 'g') = k.t),
per AS (SELECT doc_id, min(CASE WHEN w THEN license END) AS wl, array_to_string(list_sort(list(DISTINCT license)), ',') AS ls
        FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(p.wl, '') AS whole_license, coalesce(p.ls, '') AS licenses FROM documents d LEFT JOIN per p USING (doc_id)"""

ORACLES["op5_substrings"] = r"""
WITH words AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
tokens AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS x, len(w) AS n FROM words),
starts AS (SELECT doc_id, k AS s, n, string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS t FROM tokens),
windows AS (SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS n FROM starts WHERE s + 19 <= n),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(0, 20)) AS k FROM windows WHERE n > 1),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY k) AS t FROM tokens ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)"""

ORACLES["op7_decontamination"] = r"""
WITH docs AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
items AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS t
            FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM items WHERE len(w) > 0)),
places AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
found AS (SELECT p.doc_id, p.s, p.n, x.item_id FROM places p JOIN windows x ON x.n = p.n AND x.t = array_to_string(p.w[p.s:p.s + p.n - 1], ' ')),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, s + unnest(range(0, n)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults put in by a digest of conversation and turn: dropped, emptied, cut short, repeated, or given to the user."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(place) % 20).alias("_fault")).where("_fault <> 0")
    now = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"), now.alias("text"),
                       F.explode(F.sequence(F.lit(1), F.when(F.col("_fault") == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")


@query
def op11_conversations(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    return dialogue.report(dialogue.repair(damaged(turns)), turns)


@query
def op12_secrets(spark, sf_dir):
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    counts = {f"n_{kind}": F.size(F.filter("base", _is(kind))).cast("long") for kind in secrets.KINDS[:3]}
    return found.select("doc_id", *[c.alias(name) for name, c in counts.items()], F.sha2(secrets.told(F.col("base")), 256).alias("base_sha256"),
                        secrets.told(F.col("spans")).alias("spans"))


@query
def op13_merkle_manifest(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    plain = merkle.leaf_digest([F.col(c) for c in merkle.COLUMNS])
    unbroken = merkle.leaf_digest([F.translate("text", "\n", "") if c == "text" else F.col(c) for c in merkle.COLUMNS])
    found = merkle.manifest(docs, also={"told": F.when(_remainder(2) == 0, unbroken).otherwise(plain)})
    folded = merkle.fold(F.col("told"), F.col("lefts"), F.col("rights"))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("lefts"), F.col("rights")).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string, bit by bit."""
    byte = "list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda x: 0::BIGINT)), lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda crc, b: {byte}), 4294967295::BIGINT)"


def _leaf_sql(text: str) -> str:
    told = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(told)})"


def _beside_sql(nodes: str, keys: str) -> str:
    run = f"OVER (PARTITION BY {keys}, lv, k // 3 ORDER BY k ROWS BETWEEN"
    return f"""SELECT {keys}, lv, k, n, coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
       coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {nodes} WHERE n > 1"""


ORACLES["op13_merkle_manifest"] = rf"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS k, count(*) OVER (PARTITION BY source) AS n,
           {_leaf_sql("text")} AS leaf, CASE WHEN {_crc32_sql("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS told
    FROM documents),
nodes AS (SELECT source, 0 AS lv, k, n, leaf AS digest FROM leaves
          UNION ALL SELECT source, lv + 1, k // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY k)) FROM nodes WHERE n > 1 GROUP BY source, lv, k // 3, n),
tops AS (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS k, count(*) OVER () AS n FROM nodes WHERE n = 1),
over_ AS (SELECT 0 AS t, 0 AS lv, k, n, digest FROM tops
          UNION ALL SELECT t, lv + 1, k // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY k)) FROM over_ WHERE n > 1 GROUP BY t, lv, k // 3, n),
beside AS ({_beside_sql("nodes", "source")}),
above AS ({_beside_sql("over_", "t")}),
path AS (SELECT doc_id, source, leaf, told AS folded, '' AS proof, 0 AS lv, k, n FROM leaves
         UNION ALL SELECT p.doc_id, p.source, leaf, sha256(l || folded || r), proof || l || r, p.lv + 1, p.k // 3, (p.n + 2) // 3
         FROM path p JOIN beside b ON b.source IS NOT DISTINCT FROM p.source AND b.lv = p.lv AND b.k = p.k),
climbed AS (SELECT doc_id, leaf, digest AS subroot, folded, proof, 0 AS lv, t.k, t.n FROM path p JOIN tops t ON t.source IS NOT DISTINCT FROM p.source WHERE p.n = 1
            UNION ALL SELECT doc_id, leaf, subroot, sha256(l || folded || r), proof || l || r, c.lv + 1, c.k // 3, (c.n + 2) // 3
            FROM climbed c JOIN above a ON a.lv = c.lv AND a.k = c.k)
SELECT doc_id, leaf, subroot, o.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = o.digest AS verified
FROM climbed c, (SELECT digest FROM over_ WHERE n = 1) o WHERE c.n = 1"""


def _least_sql(*candidates: str) -> str:
    return f"list_sort([x FOR x IN [{', '.join(candidates)}] IF x IS NOT NULL])[1]"


def _edit_sql(cost: str, edit: str, rest: str, line: str | None) -> str:
    lines = f"list_prepend({line}, {rest}.r)" if line else f"{rest}.r"
    return f"{{'c': {cost} + {rest}.c, 't': '{edit}' || {rest}.t, 'r': {lines}}}"


_MADE = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
_KEEP = {0: "CASE code WHEN 's' THEN v1 WHEN 'u' THEN v2 END", 1: "CASE code WHEN 'u' THEN v2 END", 2: "CASE code WHEN 'a' THEN v3 END", 3: "CASE code WHEN 'u' THEN v2 END"}
_TURN_SQL = ", ".join(
    _least_sql(_edit_sql("3", "D", f"v{s}", None),
               f"CASE WHEN NOT gone AND k{s} IS NOT NULL THEN {_edit_sql('short', 'K', f'k{s}', 'line')} END",
               f"CASE WHEN NOT gone THEN {_edit_sql('2 + short', 'R', f'v{state}', repr(role + ':') + ' || text')} END") + f" AS b{s}"
    for s, (state, role) in _MADE.items())
_GAP_SQL = ", ".join(
    _least_sql(f"b{s}", _edit_sql("2", "I", f"b{state}", repr(role + ":")),
               f"{{'c': 4 + b{_MADE[state][0]}.c, 't': 'II' || b{_MADE[state][0]}.t, 'r': list_concat(['{role}:', '{_MADE[state][1]}:'], b{_MADE[state][0]}.r)}}") + f" AS v{s}"
    for s, (state, role) in _MADE.items())
#: the cheapest edits from a row to the end, with their audit and lines, for each of the four states; so the least audit is exact
ORACLES["op11_conversations"] = rf"""
WITH RECURSIVE marked AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS f FROM conversations),
damaged AS (SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END))
            FROM marked WHERE f <> 0),
placed AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
                  count(*) OVER (PARTITION BY conv_id) AS n FROM damaged),
faults AS (SELECT *, NOT regexp_matches(text, '[^ 	-]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS again,
                  NOT regexp_matches(text, '[.!?][ 	-]*\z') AS cut, substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS p FROM placed),
coded AS (SELECT *, blank OR again AS gone, CASE WHEN cut THEN 1 ELSE 0 END AS short, CASE WHEN i IN ('s', 'u', 'a') THEN i ELSE 'x' END AS code, role || ':' || text AS line FROM faults),
step AS (SELECT conv_id, n + 1 AS k, {{'c': 0::BIGINT, 't': '', 'r': []::VARCHAR[]}} AS v0, {{'c': 4::BIGINT, 't': 'II', 'r': ['user:', 'assistant:']}} AS v1,
                {{'c': 2::BIGINT, 't': 'I', 'r': ['assistant:']}} AS v2, {{'c': 0::BIGINT, 't': '', 'r': []::VARCHAR[]}} AS v3 FROM (SELECT DISTINCT conv_id, n FROM coded)
         UNION ALL
         SELECT conv_id, k, {_GAP_SQL} FROM (SELECT conv_id, k, {_TURN_SQL} FROM (
             SELECT c.*, v0, v1, v2, v3, {", ".join(f"{_KEEP[s]} AS k{s}" for s in _KEEP)} FROM step JOIN coded c ON c.conv_id IS NOT DISTINCT FROM step.conv_id AND c.k = step.k - 1))),
best AS (SELECT conv_id, v0 FROM step WHERE k = 1),
sums AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
                count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated, count(*) FILTER (p IS NOT NULL AND p || i NOT IN ('su', 'ua', 'au')) AS illegal
         FROM coded GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(v0.c, 0)::BIGINT AS cost, coalesce(v0.t, '') AS audit, sha256(coalesce(array_to_string(v0.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id"""
