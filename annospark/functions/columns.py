"""Column functions of the domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, digits: int) -> Column:
    """Rounds half up, and takes what lies within a millionth of a unit below a tie for one: sums in another order give the same."""
    scale = float(10**digits)
    return F.floor(x * scale + 0.500001) / scale


def rounded_sql(x: str, digits: int) -> str:
    """The same in DuckDB's SQL."""
    return f"(floor({x} * {10**digits}::double + 0.500001) / {10**digits}::double)"


def stem(path: Column) -> Column:
    """File name without folder and last extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def without_suffix(name: Column, suffix: str = ".wav") -> Column:
    """Name less one trailing suffix."""
    return F.when(F.endswith(name, F.lit(suffix)), F.substr(name, F.lit(1), F.length(name) - len(suffix))).otherwise(name)


def short_stem(name: Column, parts: int = 2) -> Column:
    """The last parts of a name that is joined by underscores."""
    cut = F.split(name, "_")
    return F.array_join(F.slice(cut, F.greatest(F.lit(1), F.size(cut) - parts + 1), F.lit(parts)), "_")


def hhmmss(seconds: Column) -> Column:
    """Whole seconds as HH:MM:SS."""
    s = F.floor(seconds)
    pad = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat_ws(":", F.when(s < 360_000, pad(F.floor(s / 3600))).otherwise(F.floor(s / 3600).cast("string")), pad(F.floor(s / 60) % 60), pad(s % 60))


def human_size(n: Column) -> Column:
    """Bytes with one digit in the largest unit that leaves 1 or more, whole bytes below."""
    out = F.concat(n.cast("long").cast("string"), F.lit(" B"))
    for power, unit in ((1, "KB"), (2, "MB"), (3, "GB"), (4, "TB"), (5, "PB")):
        out = F.when(n >= 1024**power, F.concat(F.format_string("%.1f", n / float(1024**power)), F.lit(f" {unit}"))).otherwise(out)
    return out


def human_duration(seconds: Column) -> Column:
    """45s below a minute, 3m 20s below an hour, 2h 15m from then on."""
    whole = F.floor(seconds)
    minutes = F.format_string("%dm %ds", F.floor(whole / 60), whole % 60)
    hours = F.format_string("%dh %dm", F.floor(whole / 3600), F.floor(whole % 3600 / 60))
    return F.when(seconds < 60, F.format_string("%ds", F.bround(seconds).cast("long"))).when(seconds < 3600, minutes).otherwise(hours)


def clip_key(uid: Column, idx: Column) -> Column:
    """uid and clip number with four digits."""
    return F.concat(uid.cast("string"), F.lit("_"), F.format_string("%04d", idx))


def level(x: Column, low: float = 0.33, high: float = 0.66) -> Column:
    """lo, mid or hi."""
    return F.when(x <= low, "lo").when(x >= high, "hi").otherwise("mid")


def descriptive_name(density: Column, iou: Column, turns: Column, dominant: Column) -> Column:
    """Name of a clip from the levels of its statistics."""
    pace = F.when(turns < 10, "few").when(turns > 50, "many").otherwise("some")
    return F.concat_ws("_", F.coalesce(dominant, F.lit("UNK")), F.concat(F.lit("density-"), level(density)), F.concat(F.lit("iou-"), level(iou)), F.concat(F.lit("turns-"), pace))


def encode_label(label: Column, ids: dict[str, int], unknown: int | None = None) -> Column:
    """Id of a label; null gives `unknown` or -1, an unlisted label `unknown` or an error."""
    found = F.lit(None).cast("int")
    for name, i in ids.items():
        found = F.when(label == name, F.lit(i)).otherwise(found)
    missing = F.lit(unknown) if unknown is not None else F.raise_error(F.concat(F.lit("unknown label: "), label)).cast("int")
    return F.when(label.isNull(), F.lit(-1 if unknown is None else unknown)).otherwise(F.coalesce(found, missing))


def decode_label(i: Column, ids: dict[str, int]) -> Column:
    """Label of an id; null where there is none."""
    out = F.lit(None).cast("string")
    for name, n in ids.items():
        out = F.when(i == n, F.lit(name)).otherwise(out)
    return out


def seeded(key: Column, *seeds: int) -> Column:
    """Hash of a key and seeds that any engine with md5 can tell: rows ordered by it are a fixed random permutation."""
    return F.md5(F.concat_ws(":", key.cast("string"), *[F.lit(str(x)) for x in seeds]))
