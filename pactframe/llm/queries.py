"""The operators of this package applied to whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch_path
from . import byte_bpe, licenses, secrets, warc
from .common import ship, table
from .exact_dedup import exact_dedup
from .fingerprints import edit_likeness, entropy_ranks
from .jaccard_join import jaccard_join
from .merkle import hex_text, manifest
from .packing import pack
from .periodic import periodic_runs
from .quality import quality_scores
from .toxicity import toxicity_scores
from .vector_dedup import near_vectors

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its class, and the number of documents with at least 0.8 of its five-word runs."""
    return jaccard_join(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, checksums=True)
    return byte_bpe.decode(encoded, ranks).select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids_packed") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids_packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "offsets_crc32",
    )


def _remainder(of: int):
    return F.crc32(F.col("id").cast("string").cast("binary")) % of


def _scored(found: DataFrame, held_out) -> DataFrame:
    return found.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "score", "predicted")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=_remainder(3) != 1
    )
    return _scored(found, _remainder(3) == 1)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.page_payloads(warc.reassemble(warc.read_warc(spark, path)))


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = secrets.span_list("spans", secrets.BASE_KINDS)
    return secrets.secret_spans(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        *(count(kind) for kind in secrets.BASE_KINDS),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        secrets.span_list("spans").alias("spans"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=_remainder(5) != 0
    )
    return _scored(found, _remainder(5) == 0)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return packed.select(
        F.col("id").alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"),
        "ids_crc32", "sequence_id", "offset",
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_matches(table(spark, sf_dir, "documents"))
    matches = F.array_join(
        F.transform(
            "matches", lambda m: F.concat_ws(":", m["unit"], m["number"].cast("string"), m["license"])
        ),
        ",",
    )
    return found.select(
        F.col("id").alias("doc_id"), "license", F.round("dice", 6).alias("dice"), "n_matches", matches.alias("matches")
    )


def op10_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices anywhere in a text; `op10_licenses` has the units that its SQL has."""
    found = licenses.license_windows(table(spark, sf_dir, "documents"))
    windows = F.array_join(
        F.transform(
            "windows",
            lambda w: F.concat_ws(":", w["start"].cast("string"), w["words"].cast("string"), w["license"]),
        ),
        ",",
    )
    return found.select(
        F.col("id").alias("doc_id"), "license", F.round("dice", 6).alias("dice"), "n_windows", windows.alias("windows")
    )


def _checksum(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """`doc_id, text` of all documents; where ten divides the checksum of the id, the words from some place
    on repeat with some period."""
    space = r"[ \t-\r]+"
    chosen = F.coalesce(_checksum("doc_id") % 10 == 0, F.lit(False))
    words = F.filter(F.split("text", space), lambda w: w != "")
    cut = docs.select(
        "doc_id", "text", F.when(chosen, words).alias("words"), F.floor(_checksum("doc_id") / 10).alias("g")
    )
    n = F.greatest(F.size("words"), F.lit(1))
    first = F.col("g") % n
    period = 1 + F.floor((n - first) / (3 + F.col("g") % 8))
    placed = cut.select("*", first.cast("int").alias("a"), period.cast("int").alias("p"))
    repeated = F.transform(
        "words",
        lambda w, i: F.when(i < F.col("a"), w).otherwise(
            F.get(F.col("words"), F.col("a") + (i - F.col("a")) % F.col("p"))
        ),
    )
    text = F.when(F.size("words") > 0, F.array_join(repeated, " ")).otherwise(F.col("text"))
    return placed.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its periodic runs, the one of the most repeats, and checksums."""
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    best = F.expr(
        "aggregate(runs, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>), "
        "(b, r) -> if(b IS NULL OR r.length * b.period > b.length * r.period, r, b))"
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of an edited copy that ends as the next document begins."""
    docs = table(spark, sf_dir, "documents")
    found = edit_likeness(docs, entropy_ranks(docs))
    return found.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        *(F.translate(F.base64(c), "\r\n", "").alias(c) for c in ("fingerprint", "edited_fingerprint")),
        "near_edited", "near_next",
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest; where the checksum of its id is even, a version of the tree
    in which its line breaks are gone."""
    chosen = _checksum("doc_id") % 2 == 0
    text = F.when(chosen, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = manifest(table(spark, sf_dir, "documents"), {"text": text})
    beside = F.transform("steps", lambda s: F.concat(hex_text(s["left"]), hex_text(s["right"])))
    return found.select(
        F.col("id").alias("doc_id"), hex_text(F.col("leaf")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"), hex_text(F.col("root")).alias("root"),
        F.sha2(F.array_join(beside, "").cast("binary"), 256).alias("proof_sha256"),
        hex_text(F.col("folded")).alias("folded_root"), "verified",
    )


def queries() -> dict[str, Query]:
    import corpus_pipeline

    def shipped(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        return run

    found = {
        "op1_jaccard_join": op1_jaccard_join,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_quality": op3_quality,
        "op4_warc": op4_warc,
        "op5_near_vectors": op5_near_vectors,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_secrets": op7_secrets,
        "op8_toxicity": op8_toxicity,
        "op9_packing": op9_packing,
        "op10_licenses": op10_licenses,
        "op10_license_windows": op10_license_windows,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_fingerprints": op12_fingerprints,
        "op13_merkle_manifest": op13_merkle_manifest,
        "pipeline": corpus_pipeline.run,
    }
    return {name: shipped(query) for name, query in found.items()}


UPPER, LOWER = licenses.ascii_uppercase, licenses.ascii_lowercase

EXACT_SQL = f"""
WITH bodies AS (
    SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS body FROM documents
), kept_ids AS (
    SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM bodies GROUP BY body
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM bodies JOIN kept_ids USING (body)"""

WARC_SQL = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT payload_digest, min(page_id) AS first_id FROM payloads WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload_digest)"""

VECTOR_SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
        ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other
), components AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN counts USING (vec_id)"""

JACCARD_SQL = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
    FROM documents
), grams AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
    FROM worded
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b USING (g)
    WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), classes AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id),
counts AS (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, class_id, coalesce(n, 0) AS n_links FROM classes LEFT JOIN counts USING (doc_id)"""


def _license_sql() -> str:
    rows, number = [], 0
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            grams = licenses.template_bigrams(text)
            rows += [f"('{gram}', {n}, '{name}', {number}, {grams.total()})" for gram, n in grams.items()]
            number += 1
    return f"""
WITH known(gram, times, license, template, size) AS (VALUES {", ".join(rows)}),
normal AS (
    SELECT doc_id, regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^a-z0-9\n]+', ' ', 'g') AS body
    FROM documents
), cut AS (
    SELECT doc_id, 'text' AS unit, [body] AS parts FROM normal
    UNION ALL SELECT doc_id, 'paragraph', regexp_split_to_array(body, '\n *\n') FROM normal
    UNION ALL SELECT doc_id, 'line', string_split(body, chr(10)) FROM normal
), units AS (
    SELECT doc_id, unit, unnest(range(len(parts))) AS number, unnest(parts) AS body FROM cut
    WHERE unit = 'text' OR len(parts) > 1
), worded AS (
    SELECT doc_id, unit, number, string_split(trim(regexp_replace(body, '[ \n]+', ' ', 'g')), ' ') AS w FROM units
), grams AS (
    SELECT doc_id, unit, number, len(w) - 1 AS held, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram
    FROM worded
), counted AS (
    SELECT doc_id, unit, number, held, license, template, size, gram, least(count(*), any_value(times)) AS c
    FROM grams JOIN known USING (gram) GROUP BY ALL
), dices AS (
    SELECT doc_id, unit, number, license, 2.0 * sum(c) / (held + size) AS dice FROM counted
    GROUP BY doc_id, unit, number, held, license, template, size
), hits AS (
    SELECT doc_id, unit, number, license, max(dice) AS dice FROM dices GROUP BY ALL HAVING max(dice) >= {licenses.THRESHOLD}
), best AS (
    SELECT doc_id, max(dice) AS dice, count(*)::INT AS n_matches,
        string_agg(unit || ':' || number || ':' || license, ',' ORDER BY unit, number, license) AS matches,
        min(license) FILTER (dice = top) AS license
    FROM (SELECT *, max(dice) OVER (PARTITION BY doc_id) AS top FROM hits) GROUP BY doc_id
)
SELECT doc_id, license, round(dice, 6) AS dice, coalesce(n_matches, 0)::INT AS n_matches, coalesce(matches, '') AS matches
FROM documents LEFT JOIN best USING (doc_id)"""


def _crc32_sql(number: str) -> str:
    """CRC-32 of a number's decimal text, bit by bit."""
    codes = f"list_transform(range(1, len({number}::VARCHAR) + 1), lambda i: ord(({number}::VARCHAR)[i])::UBIGINT)"
    bits = (
        "list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]), "
        "lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)"
    )
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda c, b: {bits}), 4294967295)"


def _periodic_sql() -> str:
    """Every period of every document: the words that equal the one a period on, as ones and noughts, cut at
    the noughts."""
    crc = _crc32_sql("doc_id")
    return f"""
WITH cut AS MATERIALIZED (
    SELECT doc_id, {crc} AS h, {crc} // 10 AS g,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w
    FROM documents
), placed AS (
    SELECT *, (g % greatest(len(w), 1))::BIGINT AS a,
        1 + ((len(w) - (g % greatest(len(w), 1))::BIGINT) // (3 + g % 8))::BIGINT AS p FROM cut
), worded AS MATERIALIZED (
    SELECT doc_id, CASE WHEN h % 10 = 0 AND len(w) > 0
        THEN list_transform(range(len(w)), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w
    FROM placed
), hashed AS (SELECT doc_id, list_transform(w, lambda x: hash(x)) AS w, len(w) AS n FROM worded),
periods AS (SELECT doc_id, w, n, unnest(range(1, n // 3 + 1)) AS q FROM hashed),
marks AS (
    SELECT doc_id, q, list_transform(list_zip(w[1:n - q], w[q + 1:]), lambda z: z[1] = z[2]) AS same FROM periods
), lines AS (
    SELECT doc_id, q, array_to_string(list_transform(same, lambda x: CASE WHEN x THEN '1' ELSE '0' END), '') AS line
    FROM marks WHERE list_contains(same, true)
), parts AS (
    SELECT doc_id, q, string_split(line, '0') AS parts FROM lines WHERE contains(line, repeat('1', greatest(24 - q, 2 * q)))
), spots AS (
    SELECT doc_id, q, unnest(list_transform(parts, lambda x: len(x))) AS size, unnest(range(len(parts))) AS k FROM parts
), stretches AS (
    SELECT doc_id, q, size, (sum(size + 1) OVER (PARTITION BY doc_id, q ORDER BY k) - size - 1)::BIGINT AS start FROM spots
), runs AS MATERIALIZED (
    SELECT doc_id, start, size + q AS length, min(q) AS period FROM stretches
    WHERE size + q >= greatest(24, 3 * q) GROUP BY ALL
), best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (
        PARTITION BY doc_id ORDER BY length::DECIMAL(38, 18) / period DESC, start, period
    ) = 1
), said AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS line
    FROM runs GROUP BY doc_id
), gone AS (
    SELECT doc_id, list_distinct(flatten(list(range(start + period, start + length)))) AS places FROM runs GROUP BY doc_id
), kept AS (
    SELECT worded.doc_id, CASE WHEN places IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
        list_where(w, list_transform(range(len(w)), lambda i: NOT list_contains(places, i))), ' ') END AS body
    FROM worded LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, length * 1000 // period AS exponent_milli,
    sha256(coalesce(line, '')) AS runs_sha256, sha256(body) AS collapsed_sha256
FROM kept LEFT JOIN said USING (doc_id) LEFT JOIN best USING (doc_id)"""


def _climb_sql(name: str, rows: str, levels: int) -> list[str]:
    """Tables `{name}_{k}`: the rows (tree, pos, digest, cur, path, rest) after k levels of runs of three."""
    out = [f"{name}_0 AS MATERIALIZED ({rows})"]
    for k in range(levels):
        out.append(f"""{name}_nodes_{k} AS MATERIALIZED (
            SELECT tree, pos, any_value(digest) AS digest FROM {name}_{k} GROUP BY ALL
        ), {name}_runs_{k} AS MATERIALIZED (
            SELECT tree, pos // 3 AS up, list(digest ORDER BY pos) AS run, max(size) AS size
            FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS size FROM {name}_nodes_{k}) GROUP BY ALL
        ), {name}_{k + 1} AS MATERIALIZED (
            SELECT tree, up AS pos, CASE WHEN size > 1 THEN sha256(array_to_string(run, '')) ELSE digest END AS digest,
                CASE WHEN size > 1 THEN sha256(array_to_string(run[1:pos % 3], '') || cur || array_to_string(run[pos % 3 + 2:], ''))
                    ELSE cur END AS cur,
                path || CASE WHEN size > 1 THEN array_to_string(run[1:pos % 3], '') || array_to_string(run[pos % 3 + 2:], '')
                    ELSE '' END AS path, rest
            FROM {name}_{k} JOIN {name}_runs_{k} USING (tree) WHERE up = pos // 3
        )""")
    return out


def _merkle_sql(levels: int = 14) -> str:
    """Runs of three up to 3 ** `levels` leaves, written out level by level."""

    def leaf(text: str) -> str:
        fields = ["doc_id", "source", "lang", "n_chars", text]
        return "sha256(" + " || ".join(f"coalesce(strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR, '-')" for f in fields) + ")"

    tampered = f"CASE WHEN {_crc32_sql('doc_id')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    leaves = f"""
        SELECT coalesce('=' || source, '-') AS tree,
            row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos,
            {leaf("text")} AS digest, {leaf(tampered)} AS cur, '' AS path, {{'id': doc_id, 'leaf': {leaf("text")}}} AS rest
        FROM documents"""
    subroots = f"""
        SELECT '' AS tree, dense_rank() OVER (ORDER BY tree) - 1 AS pos, digest, cur, path,
            {{'id': rest.id, 'leaf': rest.leaf, 'subroot': digest}} AS rest
        FROM leaf_{levels}"""
    steps = _climb_sql("leaf", leaves, levels) + _climb_sql("sub", subroots, levels)
    return f"""
WITH {", ".join(steps)}
SELECT rest.id AS doc_id, rest.leaf AS leaf, rest.subroot AS subroot, digest AS root, sha256(path) AS proof_sha256,
    cur AS folded_root, cur = digest AS verified
FROM sub_{levels}"""


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {
        "op1_jaccard_join": JACCARD_SQL,
        "op4_warc": WARC_SQL,
        "op5_near_vectors": VECTOR_SQL,
        "op6_exact_dedup": EXACT_SQL,
        "op10_licenses": _license_sql(),
        "op11_periodic_runs": _periodic_sql(),
        "op13_merkle_manifest": _merkle_sql(),
    }
    if corpus_pipeline.ORACLE_SQL is not None:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
