"""One query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from priorframe.llm import byte_bpe, collisions, conversations, katz, line_crf, mixing, positional_index, records, setjoin, sharding, suffix_index, toxicity, whitening
from priorframe.llm.common import documents, table
from priorframe.llm.registry import ORACLES, QUERIES, query


@query("op1_katz_backoff")
def katz_backoff(spark, sf_dir):
    return katz.score(documents(spark, sf_dir))


@query("op2_suffix_levels")
def suffix_levels(spark, sf_dir):
    return suffix_index.repeated_text(documents(spark, sf_dir))


@query("op3_minimax_shards")
def minimax_shards(spark, sf_dir):
    return sharding.shard(documents(spark, sf_dir), shards=40)


@query("op4_capped_mix")
def capped_mix(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


@query("op5_toxic_sentences")
def toxic_sentences(spark, sf_dir):
    return toxicity.score(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op6_projection_collisions")
def projection_collisions(spark, sf_dir):
    return collisions.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_line_quality")
def line_quality(spark, sf_dir):
    return line_crf.quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op8_byte_bpe")
def byte_bpe_round_trip(spark, sf_dir):
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(documents(spark, sf_dir), vocabulary, public_tokenizers.PATTERN)


@query("op9_token_records")
def token_records(spark, sf_dir):
    import public_tokenizers

    return records.token_records(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_set_relation_join")
def set_relation_join(spark, sf_dir):
    return setjoin.near_duplicates(documents(spark, sf_dir))


@query("op11_jacobi_whitening")
def jacobi_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query(
    "op12_positional_decontamination",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
    b AS (
      SELECT item_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
      FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
    places AS (
      SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS gram
      FROM d, (SELECT DISTINCT size FROM windows) AS s, unnest(range(1, len(w) - size + 2)) AS t(i)),
    found AS (SELECT r, i, p.size, item_id FROM places AS p JOIN windows AS v ON p.gram = v.gram AND p.size = v.size),
    hit AS (
      SELECT r, count(DISTINCT place) AS n_hit
      FROM (SELECT DISTINCT r, i, size FROM found), unnest(range(i, i + size)) AS t(place) GROUP BY r),
    listed AS (
      SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
    """,
)
def positional_decontamination(spark, sf_dir):
    return positional_index.decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


# States: 0 nothing, 1 system, 2 user, 3 assistant; a way is its cost, its audit and the lines that it leaves.
FAR = "{'c': 1000000000, 'a': '', 't': ''}"
GIVEN = (2, 2, 3, 2)
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def way(cost: str, letter: str, line: str | None, rest: str) -> str:
    lines = f"{line} || CASE WHEN {rest}.t = '' THEN '' ELSE chr(10) || {rest}.t END" if line else f"{rest}.t"
    return f"{{'c': {rest}.c + {cost}, 'a': '{letter}' || {rest}.a, 't': {lines}}}"


def row_ways(state: int) -> str:
    """The least of deleting, keeping and giving a role to one row, given the ways behind it."""
    name = "assistant" if GIVEN[state] == 3 else "user"
    found = [way("3", "D", None, f"f{state}")]
    for (initial, at), to in KEPT.items():
        if at == state:
            found.append(f"CASE WHEN NOT gone AND left(role, 1) = '{initial}' THEN {way('cut', 'K', "role || ':' || text", f'f{to}')} ELSE {FAR} END")
    found.append(f"CASE WHEN gone THEN {FAR} ELSE {way('2 + cut', 'R', f"'{name}:' || text", f'f{GIVEN[state]}')} END")
    return f"list_min([{', '.join(found)}]) AS g{state}"


def inserts(source: str, out: str) -> str:
    """Ways with at most one more inserted turn before them."""
    name = lambda s: "assistant" if GIVEN[s] == 3 else "user"
    return ", ".join(f"list_min([{source}{s}, {way('2', 'I', f"'{name(s)}:'", f'{source}{GIVEN[s]}')}]) AS {out}{s}" for s in range(4))


@query(
    "op13_conversation_repair",
    f"""
    WITH RECURSIVE bits AS (
      SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
      FROM range(256) AS r(i)),
    keyed AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
      FROM conversations),
    acted AS (
      SELECT keyed.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT))),
                                      lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS INT)])), 4294967295) % 20 AS act
      FROM keyed, bits),
    damaged AS (
      SELECT conv_id, turn, CASE act WHEN 4 THEN 'user' ELSE role END AS role,
             CASE act WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM acted, range(CASE act WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p, count(*) OVER (PARTITION BY conv_id) AS n,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
      FROM damaged),
    judged AS (
      SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate'
                     WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) || left(role, 1) AS pair
      FROM placed),
    figures AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
             count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM judged GROUP BY conv_id),
    edges AS (
      SELECT conv_id, n - p + 1 AS k, n, role, text, fault IN ('blank', 'duplicate') AS gone, CAST(fault = 'truncated' AS INT) AS cut FROM judged),
    ends AS (SELECT {{'c': 0, 'a': '', 't': ''}} AS g0, {FAR} AS g1, {FAR} AS g2, {{'c': 0, 'a': '', 't': ''}} AS g3),
    closed AS (SELECT {inserts('h', 'f')} FROM (SELECT {inserts('g', 'h')} FROM ends)),
    dp AS (
      SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS k, n, f0, f1, f2, f3 FROM edges, closed
      UNION ALL
      SELECT conv_id, k, n, {inserts('h', 'f')}
      FROM (SELECT conv_id, k, n, {inserts('g', 'h')}
            FROM (SELECT e.conv_id, e.k, e.n, {', '.join(row_ways(s) for s in range(4))}
                  FROM dp JOIN edges AS e ON e.conv_id IS NOT DISTINCT FROM dp.conv_id AND e.k = dp.k + 1)))
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, CAST(coalesce(f0.c, 0) AS BIGINT) AS cost, coalesce(f0.a, '') AS audit, sha256(coalesce(f0.t, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) AS c
    LEFT JOIN figures AS g ON g.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN (SELECT * FROM dp WHERE k = n) AS d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
)
def conversation_repair(spark, sf_dir):
    return conversations.digests(table(spark, sf_dir, "conversations"))


__all__ = ["ORACLES", "QUERIES"]
