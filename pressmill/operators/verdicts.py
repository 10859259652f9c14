"""Model replies as data: closed-domain normalisers, JSON salvage, and replies joined back onto what was sent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Closed domains, their aliases and what a missing reply stands for.
RELATIONS = ("K1", "K2", "K3", "K4")
DIRECTIONS = ("mendukung", "tidak ada", "menyerang")
DIRECTION_ALIASES = {"berseberangan": "menyerang", "menyerang/kritik": "menyerang", "kritik": "menyerang"}
CONFIDENCES = ("tinggi", "sedang", "rendah")
DEFAULT_SECTOR = "Industri Umum"
_SMALL_BUSINESS = r"(?i)\b(?:umkm|ukm)\b|\busaha\s+mikro\b"

_KEPT = "array<struct<id:string,status:string,sub_sektor:string,alasan:string>>"
_REPLY = f"hasil {_KEPT}, dibuang {_KEPT}"


def closed(value: Column, allowed: Sequence[str], default: str, aliases: Mapping[str, str] | None = None, upper: bool = False) -> Column:
    """value in the spelling of ``allowed`` (through ``aliases``), or the default."""
    plain = F.trim(F.coalesce(value.cast("string"), F.lit("")))
    plain = F.upper(plain) if upper else F.lower(plain)
    out = F.when(plain.isin(*allowed), plain)
    for alias, name in (aliases or {}).items():
        out = out.when(plain == alias, F.lit(name))
    return out.otherwise(default)


def relation(value: Column) -> Column:
    return closed(value, RELATIONS, "K3", upper=True)


def direction(value: Column) -> Column:
    return closed(value, DIRECTIONS, "tidak ada", DIRECTION_ALIASES)


def confidence(value: Column, has_body: Column) -> Column:
    """At most 'sedang' where only the title was read."""
    level = closed(value, CONFIDENCES, "sedang")
    return F.when(~has_body & (level == "tinggi"), "sedang").otherwise(level)


def json_body(reply: Column) -> Column:
    """From the first { to the last }, control characters blanked; empty where there is none."""
    return F.regexp_replace(F.regexp_extract(F.coalesce(reply, F.lit("")), r"(?s)\{.*\}", 0), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", " ")


def salvage(reply: Column, fields: Sequence[str]) -> Column:
    """array<struct<fields>> of the reply's innermost objects, in any field order and inside broken JSON; absent fields are null."""
    objects = F.regexp_extract_all(F.coalesce(reply, F.lit("")), F.lit(r"\{[^{}]*\}"), 0)

    def field(obj: Column, name: str) -> Column:
        quoted = F.regexp_extract(obj, rf'"{name}"\s*:\s*"((?:[^"\\]|\\.)*+)"', 1)
        bare = F.regexp_extract(obj, rf'"{name}"\s*:\s*(\[[^\]]*\]|[^"\[,}}\s][^,}}\s]*)', 1)
        is_quoted = F.regexp_like(obj, F.lit(rf'"{name}"\s*:\s*"'))
        text = F.when(is_quoted, F.replace(F.replace(F.replace(quoted, F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n")), F.lit("\\\\"), F.lit("\\")))
        return text.otherwise(F.when(~bare.isin("", "null"), bare)).alias(name)

    return F.transform(objects, lambda obj: F.struct(*(field(obj, name) for name in fields)))


def batch_verdicts(sent: DataFrame, replies: DataFrame, batch: str) -> DataFrame:
    """sent (batch, id, title) with status, sub_sektor and alasan from replies (batch, reply).

    Kept rows come first, dropped ones override them, what a reply leaves out is 'review'; two title rules follow."""
    parsed = replies.select(batch, F.from_json(json_body(F.col("reply")), _REPLY).alias("r"))
    text = lambda c, default: F.trim(F.coalesce(c, F.lit(default)))
    status = F.lower(text(F.col("x.status"), "relevan"))
    sector = F.coalesce(F.nullif(text(F.col("x.sub_sektor"), DEFAULT_SECTOR), F.lit("")), F.lit(DEFAULT_SECTOR))
    kept = parsed.select(batch, F.posexplode("r.hasil").alias("i", "x")).select(
        batch, "x.id", F.lit(0).alias("_p"), "i", F.when(status.isin("relevan", "review"), status).otherwise("review").alias("status"), sector.alias("sub_sektor"), text(F.col("x.alasan"), "").alias("alasan")
    )
    dropped = parsed.select(batch, F.posexplode("r.dibuang").alias("i", "x")).select(
        batch, "x.id", F.lit(1).alias("_p"), "i", F.lit("buang").alias("status"), F.lit("-").alias("sub_sektor"), text(F.col("x.alasan"), "Bukan Sektor Industri Agro").alias("alasan")
    )
    last = kept.unionByName(dropped).filter("id is not null").groupBy(batch, "id").agg(F.max_by(F.struct("status", "sub_sektor", "alasan"), F.struct("_p", "i")).alias("_v"))
    judged = sent.join(last.withColumnRenamed("id", "_id"), (sent[batch] == last[batch]) & (sent["id"].cast("string") == F.col("_id")), "left").select(sent["*"], "_v")
    small = F.coalesce(F.rlike("title", F.lit(_SMALL_BUSINESS)), F.lit(False))
    absent = F.struct(F.lit("review").alias("status"), F.lit(DEFAULT_SECTOR).alias("sub_sektor"), F.lit("").alias("alasan"))
    final = F.when(small, F.struct(F.lit("buang").alias("status"), F.lit("-").alias("sub_sektor"), F.lit("UMKM").alias("alasan"))).otherwise(F.coalesce("_v", absent))
    return judged.withColumn("_v", final).select(*sent.columns, "_v.status", "_v.sub_sektor", "_v.alasan")
