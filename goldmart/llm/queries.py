"""The registered queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldmart.llm import bpe, chat, divergence, fertility, fingerprints, infill, langid, licenses, mixing, near_vectors, sharding, simhash, toxicity
from goldmart.llm.common import crc_fold, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), crc_fold("doc_id", 3) != 1)
    scored = toxicity.score_texts(docs, model, threshold=0.7)
    return scored.select("doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), passages=True)
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    best = F.array_max(F.transform("matches", lambda m: m["dice"]))
    lines = F.size(F.filter("matches", lambda m: m["kind"] == "line"))
    return found.select("doc_id", F.array_join(names, ",").alias("licenses"), lines.cast("long").alias("n_lines"), F.coalesce(best, F.lit(0.0)).alias("best_dice"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign(table(spark, sf_dir, "documents"), sharding.even_tree(2, 3, 4))
    return found.withColumnRenamed("id", "doc_id")


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.compare_versions(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next",
    )


#: Domains of the labelled table and their shares of the training tokens.
TARGETS = {"high": 0.75, "low": 0.2, "toxic": 0.05}


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    domain = F.when(labels["toxic"] == 1, "toxic").when(labels["quality"] == 1, "high").when(labels["quality"] == 0, "low")
    found = mixing.rates(table(spark, sf_dir, "documents"), labels.select(F.col("doc_id").alias("id"), domain.alias("domain")), TARGETS)
    rows = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(F.col("id").alias("doc_id"), "tokens", *[F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(TARGETS)], "rate")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.learn(docs, crc_fold("doc_id", 4) != 2)
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    rows = turns.unionByName(planted)
    return chat.read_back(chat.format_turns(rows, chat.text_parts(rows["text"])))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"), least_docs=30, top=50)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = fertility.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
    judged = fertility.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", "script", *fertility.FIGURES)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = infill.transform(docs, draw=infill.Draw(seed="7", share=100, spm=50), restore_too=True)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def _escaped(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for mark in chat.CONTROL:
        out = f"replace({out}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return out


def _sql_words(text: str) -> str:
    return f"list_filter(string_split_regex(regexp_replace(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), '[ \\n]+'), lambda w: w <> '')"


def _sql_grams(words: str) -> str:
    return f"CASE WHEN len({words}) < 2 THEN []::VARCHAR[] ELSE list_distinct(list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1])) END"


def _sql_templates() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({quote(name)}, {quote(body)})" for name, body in licenses.TEMPLATES)


def _uniform(name: str) -> str:
    return f"((('0x' || substr(md5('{name}:' || k), 1, 13))::BIGINT)::DOUBLE + 0.5) / {float(1 << 52)!r}"


def _descend(node: dict, path: str) -> str:
    """SQL of the tree descent: position of the largest draw at each level."""
    inner = isinstance(next(iter(node.values())), dict)
    kids = [_descend(child, f"{path}/{name}") if inner else str(name) for name, child in node.items()]
    if len(kids) == 1:
        return kids[0]
    draws = ", ".join(f"ln({_uniform(f'{path}/{name}')}) / {float(sharding._weight(child))!r}" for name, child in node.items())
    return f"(CASE list_position([{draws}], greatest({draws})) " + " ".join(f"WHEN {i + 1} THEN {kid}" for i, kid in enumerate(kids)) + " END)"


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_license_scan, op3_sharding, op4_embedding_near_dedup, op5_document_fingerprints, op6_source_mixing, op7_language_id, op8_chat_formatting,
    op9_simhash_near_dedup, op10_byte_bpe, op11_source_divergence, op12_quality_rules, op13_fill_in_middle,
)}

_MARKS = len(chat.OPEN) + len(chat.ROLE_END) + len(chat.CLOSE)

_TREE = sharding.even_tree(2, 3, 4)

SQL = {
    "op2_license_scan": f"""
        WITH t AS (SELECT license, {_sql_grams('w')} AS g FROM (SELECT license, {_sql_words('body')} AS w FROM (VALUES {_sql_templates()}) v(license, body))),
        n AS (SELECT row_number() OVER () AS row_no, doc_id, regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS norm FROM documents),
        u AS (SELECT row_no, 'text' AS kind, 0 AS unit, norm AS body FROM n
              UNION ALL SELECT row_no, 'block', unnest(range(len(x))), unnest(x) FROM (SELECT row_no, string_split_regex(norm, '\\n *\\n[ \\n]*') AS x FROM n)
              UNION ALL SELECT row_no, 'line', unnest(range(len(x))), unnest(x) FROM (SELECT row_no, string_split(norm, chr(10)) AS x FROM n)),
        g AS (SELECT row_no, kind, unit, {_sql_grams('w')} AS g FROM (SELECT *, {_sql_words('body')} AS w FROM u)),
        d AS (SELECT row_no, kind, unit, license, 2.0::DOUBLE * len(list_intersect(g.g, t.g)) / (len(g.g) + len(t.g)) AS dice
              FROM g JOIN t ON len(g.g) > 0 AND 2.0 * least(len(g.g), len(t.g)) >= 0.8 * (len(g.g) + len(t.g))),
        m AS (SELECT row_no, kind, unit, max(dice) AS dice, arg_min(license, (-dice, license)) AS license FROM d WHERE dice >= 0.8 GROUP BY ALL),
        r AS (SELECT row_no, array_to_string(list_sort(list_distinct(list(license))), ',') AS licenses, count(*) FILTER (kind = 'line') AS n_lines, max(dice) AS best_dice FROM m GROUP BY row_no)
        SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(best_dice, 0)::DOUBLE AS best_dice
        FROM n LEFT JOIN r USING (row_no)""",
    "op3_sharding": f"""
        WITH crc(i, c) AS (
            SELECT i, list_reduce(list_concat([i], range(8)), lambda a, _: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)
            FROM range(256) r(i)),
        steps AS (SELECT list(c ORDER BY i) AS t FROM crc),
        d AS (SELECT doc_id, coalesce(strlen(text), 0) + 8 AS size, coalesce(doc_id::VARCHAR, '') AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
        b AS (SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(range(length(h) // 2), lambda j: ('0x' || substr(h, 2 * j + 1, 2))::BIGINT)),
                    lambda a, x: xor(t[xor(a, x) % 256 + 1], a // 256)), 4294967295) AS text_crc32 FROM d, steps),
        s AS (SELECT *, {_descend(_TREE, '')}::INT AS shard, {_descend(sharding.grown(_TREE), '')}::INT AS grown_shard,
                     ('0x' || substr(md5('slot:' || k || ':' || size || ':' || text_crc32), 1, 3))::INT AS bucket FROM b)
        SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard FROM s""",
    "op4_embedding_near_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
        ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
               AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
               AND len(list_filter(e, lambda x: x <> 0)) > 0),
        links AS (SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b
                  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
                  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reach(u, w) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.u, l.w FROM reach r JOIN links l ON l.u = r.w),
        comp AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u),
        n AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
        SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, comp.component_id, v.vec_id = comp.component_id AS kept
        FROM v JOIN comp ON comp.u = v.vec_id LEFT JOIN n ON n.u = v.vec_id""",
    "op8_chat_formatting": f"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length({_escaped('role')}) + length({_escaped('text')}) + {_MARKS})::BIGINT AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op11_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
        o AS (SELECT r, lang, source, unnest(t) AS term FROM d),
        kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL),
        g AS (SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
              LEFT JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
        p AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p
              FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
        q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS q
              FROM (SELECT lang, term, sum(n) AS n FROM p GROUP BY ALL) JOIN (SELECT lang, any_value(v) AS v, sum(total) AS total FROM g GROUP BY lang) USING (lang)),
        f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
        pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
        ts AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM ts))
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
    "op13_fill_in_middle": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        l AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u FROM d),
        k AS (SELECT *, len(u) AS n, [('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1), ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1)] AS cuts,
                     CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
                          WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
        s AS (SELECT *, array_to_string(u[1:list_min(cuts)], '') AS a, array_to_string(u[list_min(cuts) + 1:list_max(cuts)], '') AS m,
                     array_to_string(u[list_max(cuts) + 1:], '') AS z FROM k)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(a) END::BIGINT AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256 FROM s""",
}
