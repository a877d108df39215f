"""Keyed merges as one full outer join: overwrite, partial, fill-if-empty and conservative."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnspark.functions import rules
from tarnspark.functions.text import any_of, blank, content_hash, first_filled, strip, text_or_empty


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """``df``, raising when it runs if a key comes twice."""
    counts = df.groupBy(key).agg(F.count("*").alias("_copies"), *[F.first(c).alias(c) for c in df.columns if c != key])
    ok = F.when(F.col("_copies") > 1, F.raise_error(F.concat(F.lit("duplicate key "), F.col(key).cast("string")))).otherwise(F.lit(True))
    return counts.where(F.coalesce(ok.cast("boolean"), F.lit(True))).select(*df.columns)


def _joined(old: DataFrame, new: DataFrame, key: str, how: str) -> DataFrame:
    return old.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), how)


def upsert(old: DataFrame, new: DataFrame, key: str, columns: list[str], now: Column | None = None) -> DataFrame:
    """Full overwrite: a key in ``new`` takes all its columns from there, absent ones as null. With ``now``, updated_at is
    set and created_at is kept."""
    have, there = F.col(f"n.{key}").isNotNull(), set(new.columns)
    out = [F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key)]
    for c in columns:
        fresh = F.col(f"n.{c}") if c in there else F.lit(None)
        out.append(F.when(have, fresh).otherwise(F.col(f"o.{c}")).alias(c))
    if now is not None:
        out += [F.coalesce(F.col("o.created_at"), now).alias("created_at"), F.when(have, now).otherwise(F.col("o.updated_at")).alias("updated_at")]
    return _joined(old, new, key, "full").select(*out)


def partial_upsert(old: DataFrame, new: DataFrame, key: str, groups: dict[str, list[str]], insert: bool = True) -> DataFrame:
    """Only the column groups whose flag column in ``new`` is true are overwritten; a row with no flag changes nothing. New keys are inserted with
    nulls elsewhere, or skipped without ``insert``."""
    any_flag = any_of([F.coalesce(F.col(f), F.lit(False)) for f in groups])
    owner = {c: f for f, cs in groups.items() for c in cs}
    out = [F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key)]
    for c in old.columns:
        if c != key:
            out.append((F.when(F.coalesce(F.col(f"n.{owner[c]}"), F.lit(False)), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) if c in owner else F.col(f"o.{c}")).alias(c))
    return _joined(old, new.where(any_flag), key, "full" if insert else "left").select(*out)


def update_rows(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``old`` with ``columns`` from ``new`` where it has the key, and ``replaced``, whether it has. No row is added."""
    hit = F.col(f"n.{key}").isNotNull()
    return _joined(old, new, key, "left").select(*[F.when(hit, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) if c in columns else F.col(f"o.{c}") for c in old.columns], hit.alias("replaced"))


def fill_empty(old: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """``column`` set only where it is null or empty and ``new`` has a value that isn't."""
    value = F.when((text_or_empty(F.col(f"o.{column}")) == "") & (text_or_empty(F.col(f"n.{column}")) != ""), F.col(f"n.{column}")).otherwise(F.col(f"o.{column}"))
    return _joined(old, new, key, "left").select(*[value.alias(c) if c == column else F.col(f"o.{c}") for c in old.columns])


def needs_filling(site: str = "website_url", fields=rules.FILL_FIELDS) -> Column:
    """A site and at least one blank field."""
    return ~blank(F.col(site)) & any_of([blank(F.col(f)) for f in fields])


def conservative_merge(old: DataFrame, new: DataFrame, key: str, fields=rules.FILL_FIELDS) -> DataFrame:
    """Blank fields take the new value if that isn't blank; others are never changed. ``filled`` lists the fields that were."""
    o, n = (lambda f: strip(text_or_empty(F.col(f"o.{f}")))), (lambda f: strip(text_or_empty(F.col(f"n.{f}"))))
    takes = {f: (o(f) == "") & (n(f) != "") for f in fields}
    out = [F.when(takes[c], n(c)).otherwise(text_or_empty(F.col(f"o.{c}"))).alias(c) if c in takes else F.col(f"o.{c}") for c in old.columns]
    filled = F.filter(F.array(*[F.when(t, F.lit(f)) for f, t in takes.items()]), lambda x: x.isNotNull())
    return _joined(old, new, key, "left").select(*out, filled.alias("filled"))


def contact_overlay(extracted: Column, contacts: Column) -> Column:
    """Contacts found by patterns joined by commas, else what the extractor gave."""
    return F.when(F.size(contacts) > 0, F.array_join(contacts, ", ")).otherwise(text_or_empty(extracted))


def logo_choice(extracted: Column, found: Column, cached: Column) -> Column:
    """Fresh results prefer the extractor's logo, cached ones the page's."""
    return F.when(cached, first_filled(found, extracted)).otherwise(first_filled(extracted, found))


def once_by_content(df: DataFrame, text: str, expensive, ident: list[str]) -> DataFrame:
    """``expensive(distinct contents)`` -> (content_key, ...) once for each content, joined back to every row. Only keys meet in the join back; the
    text goes to the one row that stands for its content."""

    keyed = df.withColumn("content_key", content_hash(F.col(text)))
    one = keyed.groupBy("content_key").agg(F.first(text).alias(text))
    return keyed.select(*ident, "content_key").join(expensive(one), "content_key")
