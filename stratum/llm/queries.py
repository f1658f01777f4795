"""The checked queries of the operators: thin calls over whole tables, and their SQL where there is one."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import chat, decontaminate, exact_dedup, langid, lexical_search, merkle, near_dedup, pii, quality, sentencepiece_sampling, token_counts, url_filter, warc
from stratum.llm.common import table

#: Folder of the public vocabulary files, where every node has them at another place than their package's.
VOCABULARIES = os.environ.get("STRATUM_VOCABULARIES")


def vocabulary(name: str) -> str:
    if VOCABULARIES:
        return f"{VOCABULARIES}/{name}"
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="max")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), limit=2048)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are made of control strings."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_conversations(rows, vocabulary("byte_bpe_50k.json")))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learned from; results on them show what was learned."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = langid.fit(docs.where(~held_out()))
    return langid.predict(docs, net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """Word vectors from all of ``docs``; labels only of rows that are not held out."""
    return quality.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Every page as a full response and a later (sometimes earlier) not-modified revisit, as WARC record rows.
    How the revisit names what it saw, its validators, goes round by page."""
    html, day = F.coalesce("html", F.lit("")), F.lit(86_400)
    at = F.lit(1_704_067_200) + F.col("page_id") * 7_919 % (30 * day)
    tag = F.concat(F.lit('"'), F.substring(F.md5(html), 1, 16), F.lit('"'))
    seen = F.concat(at.cast("string"), F.lit(" GMT"))

    def head(name: str, value: Column | str) -> Column:
        return F.struct(F.lit(name).alias("name"), (F.lit(value) if isinstance(value, str) else value).alias("value"))

    again = at + (F.col("page_id") % 11 - 2) * 3_600
    turn = F.col("page_id") % 5
    validator = (F.when(turn == 0, F.array(head("ETag", tag)))
                 .when(turn == 1, F.array(head("etag", F.concat(F.lit("W/"), tag))))
                 .when(turn == 2, F.array(head("Last-Modified", seen)))
                 .when(turn == 3, F.array(head("ETag", '"other"'))).otherwise(F.array().cast(warc.HEADERS)))
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("type"), "url",
        F.timestamp_seconds(at).alias("date"), F.lit(200).alias("status"),
        F.array(head("Content-Type", "text/html"), head("Date", at.cast("string")), head("ETag", tag),
                head("Last-Modified", seen), head("Cache-Control", "max-age=60")).alias("headers"),
        html.alias("payload"))
    short = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("type"), "url",
        F.timestamp_seconds(again).alias("date"), F.lit(304).alias("status"),
        F.concat(validator, F.array(head("Date", again.cast("string")), head("cache-control", "max-age=120"),
                                    head("Content-Length", "0"), head("X-Seen", "again"))).alias("headers"),
        F.lit(None).cast("string").alias("payload"))
    return full.unionByName(short)


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of all pages, written as WARC records, read again, and their revisits resolved."""
    records = warc.read_records(warc.write_records(page_captures(table(spark, sf_dir, "pages"))))
    lines = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return warc.resolve_revisits(records).select(
        "record_id", "canonical", "base_id", "outcome", "status", F.sha2(lines, 256).alias("headers_sha256"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"))


def op8_sentencepiece_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four sampled segmentations of each whole text, decoded again."""
    docs = table(spark, sf_dir, "documents")
    found = sentencepiece_sampling.encode_samples(docs, vocabulary("piece_bpe_32k.model"), k=4, decoded=True)
    return found.select("doc_id", "sample", F.size("ids").cast("long").alias("n_pieces"),
                          F.xxhash64("ids").alias("ids_hash"), "log_prob", "perturbed", "log_inclusion",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every span of every text, and beside the spans their scores in hundredths, in the same order."""
    found = pii.detect(table(spark, sf_dir, "documents"))
    written = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    base = F.transform(F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS)),
                       lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.BASE_KINDS), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                        F.array_join(written, ",").alias("spans"),
                        F.array_join(F.transform("spans", lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",")
                        .alias("scores"))


#: Fixed values of the query: which hosts and paths are allowed or blocked whatever their words are.
URL_RULES = [url_filter.Rule("org", "/", "allow"), url_filter.Rule("example.org", "/es/", "block"),
             url_filter.Rule("example.org", "/en/1", "block"), url_filter.Rule("com", "/fr/", "allow"),
             url_filter.Rule("com", "/de/", "block")]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by rules, else by its words."""
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict", "judged.n_strict",
                         "judged.n_soft", "judged.weight")


#: Fixed values of the query: the fields of a leaf, in order.
LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of all documents by language, and every document's proof, some of a document changed since."""
    one_more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    rows = merkle.leaves(table(spark, sf_dir, "documents"), LEAF_FIELDS, changed={"n_chars": one_more}, where=tampered)
    made = merkle.manifest(rows)
    root = F.lit(made.root).cast("string")
    return merkle.proofs(made, with_steps=False).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_chat_format": op3_chat_format,
    "op4_language_id": op4_language_id,
    "op5_near_dedup": op5_near_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_sentencepiece_samples": op8_sentencepiece_samples,
    "op9_quality": op9_quality,
    "op10_pii": op10_pii,
    "op11_url_filter": op11_url_filter,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_lexical_search": op13_lexical_search,
}

_TERMS = ", ".join(f"{{'t': '{t.text}', 'w': {t.weight}}}" for t in url_filter.VOCABULARY)
_AZ = f"'{url_filter.UPPER}', '{url_filter.LOWER}'"

_WRITTEN = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = " || ".join(_WRITTEN.format(f) for f in LEAF_FIELDS)
_CRC = ("xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), "
        "lambda c, x: list_reduce([xor(c, x), 1, 2, 3, 4, 5, 6, 7, 8], lambda a, i: xor(a >> 1, (a & 1) * 3988292384)), 4294967295))")

_SPLIT = "regexp_extract_all(translate(text, " + _AZ + r"), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = {
    # every document that shares a term with an item is scored
    "op13_lexical_search": f"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_SPLIT} AS w FROM documents),
             dn AS (SELECT k, doc_id, w, len(w) AS n FROM d WHERE len(w) > 0),
             s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM dn),
             it AS (SELECT DISTINCT item_id, unnest({_SPLIT}) AS t FROM benchmark),
             tf AS (SELECT k, t, count(*) AS tf FROM (SELECT k, unnest(w) AS t FROM dn) JOIN (SELECT DISTINCT t FROM it) USING (t)
                    GROUP BY k, t),
             wt AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY t, docs),
             m AS (SELECT k, doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM dn, s),
             sc AS (SELECT item_id, k, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
                    FROM tf JOIN wt USING (t) JOIN it USING (t) JOIN m USING (k) GROUP BY item_id, k, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
               doc_id, score
        FROM sc WHERE score > 0 QUALIFY rank <= 10""",
    # all nodes by level, siblings by their places, and the changed leaves folded level by level
    "op12_merkle_manifest": f"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS k, doc_id, lang, sha256({_LEAF}) AS leaf,
                   CASE WHEN doc_id IS NOT NULL AND {_CRC} % 7 = 0
                        THEN sha256({_LEAF.replace("n_chars", "(CAST(n_chars AS HUGEINT) + 1)")}) END AS claim
            FROM documents),
        leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, k) - 1 AS pos,
                          count(*) OVER (PARTITION BY lang) AS n FROM d),
        nodes(lang, lvl, pos, n, h) AS (
            SELECT lang, 0, pos, n, leaf FROM leaves
            UNION ALL
            SELECT lang, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
            FROM nodes WHERE n > 1 GROUP BY lang, lvl, pos // 2, (n + 1) // 2),
        subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
                     FROM nodes WHERE n = 1),
        upper_(lvl, pos, n, h) AS (
            SELECT 0, pos, n, subroot FROM subroots
            UNION ALL
            SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
            FROM upper_ WHERE n > 1 GROUP BY lvl, pos // 2, (n + 1) // 2),
        low AS (SELECT k, string_agg(s.h, '' ORDER BY s.lvl) AS p FROM leaves l JOIN nodes s
                ON l.lang IS NOT DISTINCT FROM s.lang AND s.n > 1 AND s.pos = xor(l.pos >> s.lvl, 1) GROUP BY k),
        high AS (SELECT r.lang, string_agg(s.h, '' ORDER BY s.lvl) AS p FROM subroots r JOIN upper_ s
                 ON s.n > 1 AND s.pos = xor(r.pos >> s.lvl, 1) GROUP BY r.lang),
        f(k, lang, lvl, pos, n, h) AS (
            SELECT k, lang, 0, pos, n, coalesce(claim, leaf) FROM leaves
            UNION ALL
            SELECT f.k, f.lang, f.lvl + 1, f.pos // 2, (f.n + 1) // 2,
                   sha256(CASE WHEN f.pos % 2 = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END)
            FROM f LEFT JOIN nodes s ON f.lang IS NOT DISTINCT FROM s.lang AND s.lvl = f.lvl AND s.pos = xor(f.pos, 1)
            WHERE f.n > 1),
        g(k, lvl, pos, n, h) AS (
            SELECT f.k, 0, r.pos, r.n, f.h FROM f JOIN subroots r ON f.lang IS NOT DISTINCT FROM r.lang WHERE f.n = 1
            UNION ALL
            SELECT g.k, g.lvl + 1, g.pos // 2, (g.n + 1) // 2,
                   sha256(CASE WHEN g.pos % 2 = 1 THEN s.h || g.h ELSE g.h || coalesce(s.h, '') END)
            FROM g LEFT JOIN upper_ s ON s.lvl = g.lvl AND s.pos = xor(g.pos, 1) WHERE g.n > 1),
        top AS (SELECT h AS root FROM upper_ WHERE n = 1)
        SELECT l.doc_id, l.leaf, r.subroot, top.root, sha256(coalesce(low.p, '') || coalesce(high.p, '')) AS proof_sha256,
               g.h AS folded_root, g.h = top.root AS verified
        FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang CROSS JOIN top
        JOIN g ON g.k = l.k AND g.n = 1 LEFT JOIN low ON low.k = l.k LEFT JOIN high ON l.lang IS NOT DISTINCT FROM high.lang""",
    # one regular expression per term instead of an automaton; every strict hit has both neighbours looked at
    "op11_url_filter": f"""
        WITH u AS (SELECT page_id, translate(coalesce(url, ''), {_AZ}) AS low,
                          CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
                   FROM pages),
             v AS (SELECT page_id, low, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}), '') AS host,
                          coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
             w AS (SELECT *, list_filter([{{'h': 'example.org', 'p': '/en/1', 'v': 'block'}}, {{'h': 'example.org', 'p': '/es/', 'v': 'block'}},
                                          {{'h': 'com', 'p': '/fr/', 'v': 'allow'}}, {{'h': 'com', 'p': '/de/', 'v': 'block'}},
                                          {{'h': 'org', 'p': '/', 'v': 'allow'}}],
                                         lambda r: (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p))[1] AS r,
                          list_transform(list_filter([{_TERMS}], lambda t: regexp_matches(low, '(^|[^a-z0-9])' || t.t || '([^a-z0-9]|$)')),
                                         lambda t: t.w) AS found,
                          len(string_split_regex(regexp_replace(low, '[^a-z0-9]', '  ', 'g'),
                              '(^| )({"|".join(t.text for t in url_filter.VOCABULARY if t.strict)})( |$)')) - 1 AS n_strict
                   FROM v)
        SELECT page_id, host, path, r.h || r.p AS rule, CAST(n_strict AS INTEGER) AS n_strict,
               CAST(len(list_filter(found, lambda x: x < {url_filter.REJECT})) AS INTEGER) AS n_soft,
               CAST(coalesce(list_sum(found), 0) AS INTEGER) AS weight,
               coalesce(r.v, CASE WHEN list_sum(found) >= {url_filter.REJECT} THEN 'block' ELSE 'allow' END) AS verdict
        FROM w""",
    "op3_chat_format": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
             e AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(replace(role || chr(10) || text,
                       '\', '##'), '<\|', '<!|', 'g'), '<(/?s>)', '<!\1', 'g'), '\[(/?INST\])', '[!\1', 'g') AS longer
                   FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<|turn|><|text|><|end|>') + length(longer) - 1) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op7_warc_revisits": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, 1704067200 + page_id * 7919 % 2592000 AS ts,
                          '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag,
                          regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
                   FROM pages),
             q AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^www\.', ''),
                                            ':(80|443)?$', '')
                          || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
                          list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda x:
                              x <> '' AND NOT regexp_matches(x, '^(utm_[^=&]*|ref|fbclid|gclid|sessionid)(=|$)'))) AS args
                   FROM p),
             r AS (SELECT *, place || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS canonical
                   FROM q),
             v AS (SELECT page_id, canonical, ts + (page_id % 11 - 2) * 3600 AS again, page_id % 5 AS turn, tag, ts FROM r),
             j AS (SELECT v.*, b.page_id AS bp, b.ts AS b_at, b.tag AS b_tag, b.html
                   FROM v LEFT JOIN r b ON v.canonical = b.canonical AND b.ts < v.again
                   QUALIFY row_number() OVER (PARTITION BY v.page_id ORDER BY b.ts DESC NULLS LAST, b.page_id DESC) = 1),
             k AS (SELECT *, CASE WHEN bp IS NULL THEN 'no-base'
                                  WHEN turn IN (0, 1) AND tag <> b_tag OR turn = 2 AND ts <> b_at OR turn = 3
                                  THEN 'validator-mismatch' ELSE 'resolved' END AS outcome FROM j),
             h AS (SELECT *, 'Content-Type: text/html' || chr(10)
                          || CASE WHEN turn IN (0, 1) THEN '' ELSE 'ETag: ' || b_tag || chr(10) END
                          || 'Last-Modified: ' || b_at || ' GMT' || chr(10)
                          || CASE turn WHEN 0 THEN 'ETag: ' || tag || chr(10) WHEN 1 THEN 'etag: W/' || tag || chr(10) ELSE '' END
                          || 'Date: ' || again || chr(10) || 'cache-control: max-age=120' AS headers FROM k)
        SELECT page_id * 2 + 1 AS record_id, canonical, bp * 2 AS base_id, outcome,
               CASE WHEN outcome = 'resolved' THEN 200 END AS status,
               CASE WHEN outcome = 'resolved' THEN sha256(headers) END AS headers_sha256,
               CASE WHEN outcome = 'resolved' THEN CAST(strlen(html) AS BIGINT) END AS payload_bytes,
               CASE WHEN outcome = 'resolved' THEN sha256(html) END AS payload_sha256
        FROM h""",
    # every window that begins with a shingle of an item is compared with that item, without fingerprints
    "op6_decontaminate": """
        WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
             ds AS (SELECT doc_id, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS s
                    FROM dw WHERE len(w) >= 5),
             iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
             it AS (SELECT item_id, len(w) AS n_words,
                           list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS t
                    FROM iw WHERE len(w) >= 5),
             pos AS (SELECT doc_id, generate_subscripts(s, 1) AS start, unnest(s) AS g FROM ds),
             seed AS (SELECT DISTINCT item_id, n_words, t, unnest(t) AS g FROM it),
             win AS (SELECT pos.doc_id, start, item_id, n_words, t, s[start:start + n_words - 5] AS v
                     FROM pos JOIN seed USING (g) JOIN ds ON ds.doc_id = pos.doc_id),
             cv AS (SELECT doc_id, start, item_id, g, count(*) AS c
                    FROM (SELECT doc_id, start, item_id, unnest(v) AS g FROM win) GROUP BY ALL),
             ct AS (SELECT item_id, g, count(*) AS c FROM (SELECT item_id, unnest(t) AS g FROM it) GROUP BY ALL),
             both_ AS (SELECT doc_id, start, item_id, sum(least(cv.c, ct.c)) AS b
                       FROM cv JOIN ct USING (item_id, g) GROUP BY ALL),
             sim AS (SELECT doc_id, item_id, start, n_words, CAST(b AS DOUBLE) / (len(v) + len(t) - b) AS similarity
                     FROM win JOIN both_ USING (doc_id, start, item_id))
        SELECT doc_id, item_id, similarity, CAST(start - 1 AS INTEGER) AS start_word, CAST(n_words AS INTEGER) AS n_words
        FROM (SELECT * FROM sim WHERE similarity >= 0.8 UNION ALL BY NAME
              SELECT doc_id, item_id, 1.0 AS similarity, unnest(list_filter(range(1, len(dw.w) - len(iw.w) + 2),
                  lambda i: dw.w[i:i + len(iw.w) - 1] = iw.w)) AS start, len(iw.w) AS n_words
              FROM dw JOIN iw ON len(iw.w) BETWEEN 1 AND 4 AND list_has_all(dw.w, iw.w))
        QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1""",
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept,
               sha256(t) AS text_sha256
        FROM d JOIN g USING (t)""",
}


def build() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle() -> dict[str, str]:
    return dict(ORACLE)
