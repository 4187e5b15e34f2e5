"""Keep the rows of a large table whose key is in a set of keys.

The set is computed once and measured. Within the bound it is broadcast and the table is
filtered in place. Up to MOST_PASSES times the bound the set is cut into ranges of the keys' hash
and each range is broadcast in a pass of its own over the table: still nothing is shuffled but the
keys. Beyond that, only digests of the keys are matched, and the keys that hold many rows are dealt with by
broadcast: no task receives the rows of a hot key, and a hot key is 32 bytes however long it is. Rows read from
files are matched by where they are stored and then fetched from there, so that no row is shuffled
at its full width; other rows are shuffled themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import all_present
from ..functions.names import quoted
from ..scratch import checkpointed
from .findings import union_all

# Raw key bytes; a hash table of fixed-width keys takes a small multiple of this.
BROADCAST_BYTES = 32 * 1024 * 1024
# A key with this many rows is hot. A table has at most one such key per HOT_ROWS rows.
HOT_ROWS = 1_000_000
NEVER_HOT = 1 << 40
UNMEASURED = 1 << 62
MOST_PASSES = 16


def passes_for(n_bytes: int, limit: int | None = None) -> int:
    """Passes in which keys of so many bytes can each be broadcast within the bound."""
    limit = BROADCAST_BYTES if limit is None else limit
    return max(1, -(-n_bytes // max(limit, 1)))


def semi_join_in_passes(
    df: DataFrame, keys: DataFrame, same: Column, df_hash: str, key_hash: str, passes: int
) -> DataFrame:
    """Left semi join that broadcasts one range of the keys' hash in each pass over `df`. The ranges
    are disjoint, so no row is found twice."""
    if passes == 1:
        return df.join(F.broadcast(keys), same, "left_semi")
    found = []
    for place in range(passes):
        part = keys.where(f"pmod({key_hash}, {passes}) = {place}")
        rows = df.where(f"pmod({df_hash}, {passes}) = {place}")
        found.append(rows.join(F.broadcast(part), same, "left_semi"))
    return union_all(found)


def key_bytes(keys: DataFrame) -> DataFrame:
    """Size of a frame of key columns, as one row `n_bytes`. For fixed-width keys this is a
    bare row count, which columnar sources answer from file footers."""
    n_bytes = f"count(1) * {16 * len(keys.columns)}"
    for field in keys.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            n_bytes += f" + coalesce(sum(octet_length({quoted(field.name)})), 0)"
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            n_bytes += f" + {UNMEASURED}"
    return keys.selectExpr(f"CAST({n_bytes} AS bigint) AS n_bytes")


def fits_broadcast(keys: DataFrame, limit: int | None = None) -> bool:
    return key_bytes(keys).first()["n_bytes"] <= (BROADCAST_BYTES if limit is None else limit)


def rows_with_keys(
    df: DataFrame,
    keys: DataFrame,
    names: Sequence[str],
    null_safe: bool = False,
    hot_rows: int | None = None,
    broadcast_bytes: int | None = None,
    most_passes: int | None = None,
) -> DataFrame:
    """Rows of `df` whose `names` equal the key columns of a wanted row of `keys`.

    `keys` has the key columns in the same order, then `count` (rows of `df` with that key)
    and `wanted`; each key is in it once. It must hold all wanted keys and all hot ones. With
    `null_safe`, NULL parts match NULL parts.
    """
    parts = [f"__w{i}" for i in range(len(names))]
    known = checkpointed(keys.toDF(*parts, "__count", "__wanted"))
    equals = "<=>" if null_safe else "="
    same = F.expr(
        " AND ".join(f"{quoted(name)} {equals} {part}" for name, part in zip(names, parts))
    )

    def picked(condition: str) -> DataFrame:
        return known.where(condition).select(*parts)

    wanted = picked("__wanted")
    passes = passes_for(key_bytes(wanted).first()["n_bytes"], broadcast_bytes)
    if passes <= (MOST_PASSES if most_passes is None else most_passes):
        hashes = [f"xxhash64({', '.join(columns)})" for columns in (map(quoted, names), parts)]
        return semi_join_in_passes(df, wanted, same, *hashes, passes)

    least = HOT_ROWS if hot_rows is None else hot_rows
    digests = key_digest(df, names), key_digest(known, parts)
    if None in digests:
        return _shuffled(df, known, parts, same, least, broadcast_bytes)
    digest, own_digest = digests
    present = "true" if null_safe else all_present(parts)
    held = known.where(present).selectExpr(f"{own_digest} AS __digest", "__count", "__wanted")
    if not has_row_numbers(df):
        rows = df.selectExpr("*", f"{digest} AS __key_digest")
        return _split_hot(rows, held, least, broadcast_bytes).drop("__key_digest")
    places = df.selectExpr(f"{digest} AS __key_digest", f"{FILE[0]} AS __file", f"{FILE[1]} AS __file_too", f"{ROW} AS __row")
    wanted_places = _split_hot(places, held, least, broadcast_bytes).drop("__key_digest")
    return rows_at(df, checkpointed(wanted_places), broadcast_bytes)


def _split_hot(
    rows: DataFrame, keys: DataFrame, least: int, broadcast_bytes: int | None
) -> DataFrame:
    """The rows whose `__key_digest` is wanted. Keys of `least` rows or more are matched by broadcast, of which
    there is at most one per `least` rows and each is 32 bytes however long the key; the rest meet in a shuffle."""
    same = F.expr("__key_digest = __digest")
    while not fits_broadcast(keys.where(f"__count >= {least}").select("__digest"), broadcast_bytes) and least < NEVER_HOT:
        least *= 2
    hot = keys.where(f"__count >= {least}")
    from_hot = rows.join(F.broadcast(hot.where("__wanted").select("__digest")), same, "left_semi")
    others = rows.join(F.broadcast(hot.select("__digest")), same, "left_anti")
    cool = keys.where(f"__wanted AND __count < {least}").select("__digest")
    return from_hot.unionAll(others.join(cool, same, "left_semi"))


def _shuffled(
    df: DataFrame, known: DataFrame, parts: Sequence[str], same: Column, least: int, broadcast_bytes: int | None
) -> DataFrame:
    """The same by the keys' own values, for types without a digest."""

    def picked(condition: str) -> DataFrame:
        return known.where(condition).select(*parts)

    while not fits_broadcast(picked(f"__count >= {least}"), broadcast_bytes) and least < NEVER_HOT:
        least *= 2
    from_hot = df.join(F.broadcast(picked(f"__wanted AND __count >= {least}")), same, "left_semi")
    others = df.join(F.broadcast(picked(f"__count >= {least}")), same, "left_anti")
    from_others = others.join(picked(f"__wanted AND __count < {least}"), same, "left_semi")
    return from_hot.unionAll(from_others)


def key_digest(df: DataFrame, names: Sequence[str]) -> str | None:
    """SHA-256 of a key's parts as SQL text, the same for equal keys, NULLs included; None for types whose
    equality has no text."""
    texts = []
    for name in names:
        kind, column = df.select(quoted(name)).schema[0].dataType, quoted(name)
        if isinstance(kind, T.StringType) and kind.simpleString() == "string":
            text = column
        elif isinstance(kind, T.BinaryType):
            text = f"hex({column})"
        elif isinstance(kind, T.TimestampType):  # its text repeats an hour when clocks are put back
            text = f"CAST(unix_micros({column}) AS string)"
        elif isinstance(kind, (T.DoubleType, T.FloatType)):  # NaN equals NaN, 0.0 equals -0.0
            text = f"CAST({column} + CAST(0 AS {kind.simpleString()}) AS string)"
        elif isinstance(kind, (T.IntegralType, T.DecimalType, T.DateType, T.BooleanType, T.TimestampNTZType)):
            text = f"CAST({column} AS string)"
        else:
            return None
        texts.append(f"coalesce(concat(octet_length({text}), ':', {text}), '-')")
    return f"unhex(sha2(concat({', '.join(texts)}), 256))"


# Where a row is stored: its file, by two hashes of the path that together tell all files apart, and its number.
FILE = ("xxhash64(_metadata.file_path)", "xxhash64('file', _metadata.file_path)")
ROW = "_metadata.row_index"
BUCKET_ROWS = 32_768
BUCKET_BYTES = 4_200
PLACE_BYTES = 48


def has_row_numbers(df: DataFrame) -> bool:
    """Whether the rows of `df` know their file and their number in it."""
    try:
        df.selectExpr(FILE[0], ROW).schema
    except AnalysisException:
        return False
    return True


def rows_at(df: DataFrame, places: DataFrame, broadcast_bytes: int | None = None) -> DataFrame:
    """The rows of `df` stored at `places` (`__file, __file_too, __row`).

    No row of `df` is shuffled. Files are dealt over passes so that the places of each pass fit the broadcast bound;
    a pass lists and reads its own files only, so all passes together read the table once. Places are sent one
    by one, or as bitmaps of 32,768 rows where that is less; a file's places are at most a bit per row of it.
    """
    bucket, bit = f"__row div {BUCKET_ROWS}", f"__row % {BUCKET_ROWS}"
    files = places.groupBy("__file", "__file_too").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"count(DISTINCT {bucket})").alias("buckets")
    )
    seen = files.selectExpr("count(1) AS files", "sum(n) AS n", "sum(buckets) AS buckets").first()
    if not seen["files"]:
        return df.where("false")
    as_bits = seen["buckets"] * BUCKET_BYTES < seen["n"] * PLACE_BYTES
    n_bytes = seen["buckets"] * BUCKET_BYTES if as_bits else seen["n"] * PLACE_BYTES
    passes = min(passes_for(n_bytes, broadcast_bytes), seen["files"])
    sent = ["__file AS __at_file", "__file_too AS __at_file_too"]
    same = "__file = __at_file AND __file_too = __at_file_too"
    if as_bits:
        places = places.groupBy("__file", "__file_too", F.expr(bucket).alias("__bucket")).agg(
            F.expr(f"bitmap_construct_agg({bit})").alias("__bits")
        )
        sent += ["__bucket", "__bits"]
        octet = f"CAST(conv(hex(substring(__bits, CAST({bit} AS int) div 8 + 1, 1)), 16, 10) AS int)"
        same += f" AND {bucket} = __bucket AND getbit({octet}, CAST({bit} AS int) % 8) = 1"
    else:
        sent += ["__row AS __at_row"]
        same += " AND __row = __at_row"
    places = checkpointed(places.selectExpr(*sent)) if passes > 1 and as_bits else places.selectExpr(*sent)
    columns = [quoted(name) for name in df.columns]
    found = []
    for place in range(passes):
        # the condition on the path is met by listing: other files are not opened
        rows = df.where(f"pmod({FILE[0]}, {passes}) = {place}").selectExpr(
            *columns, f"{FILE[0]} AS __file", f"{FILE[1]} AS __file_too", f"{ROW} AS __row"
        )
        part = places.where(f"pmod(__at_file, {passes}) = {place}")
        found.append(rows.join(F.broadcast(part), F.expr(same), "left_semi").select(columns))
    return union_all(found)
