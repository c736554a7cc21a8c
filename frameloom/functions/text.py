"""Text helpers of the record, log, listing and review operators, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")


def short_title(title: Column) -> Column:
    """Without [...] and 【...】, each as short as possible."""
    return F.regexp_replace(title, r"\[.*?\]|【.*?】", "")


def chosen_value(label: Column, value: Column) -> Column:
    """A title in short form, unless nothing is left of it; other values as they are."""
    return F.when(label == "title", F.coalesce(F.nullif(short_title(value), F.lit("")), value)).otherwise(value)


def numbered(n: Column) -> Column:
    """At least three digits; lpad would cut longer numbers."""
    return F.format_string("%03d", n)


def shadow_label(label: Column) -> Column:
    """The label with its last two characters replaced by two underscores."""
    return F.concat(label_stem(label), F.lit("__"))


def label_stem(label: Column) -> Column:
    return F.substring(label, F.lit(1), F.greatest(F.length(label) - 2, F.lit(0)))


# Fixed value: what a log line begins with, date, time with milliseconds, and a level.
LOG_STAMP = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3} - \w+ - "


def log_message(line: Column) -> Column:
    """A log line without its stamp."""
    return F.regexp_replace(line, LOG_STAMP, "")


def frame_number(line: Column) -> Column:
    """The number in _<number>.png, or null."""
    return F.nullif(F.regexp_extract(line, r"_(\d+)\.png", 1), F.lit("")).cast("long")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def display_name(name: Column) -> Column:
    """A file name without its last extension."""
    return F.regexp_replace(name, r"\.[^.]+$", "")


def html_escape(x: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(raw), F.lit(safe))
    return x


def human_size(size: Column) -> Column:
    """Bytes in units of 1024: whole bytes, else one decimal; "-" for a negative size; PB beyond all units."""
    out = F.format_string("%.1f PB", F.bround(size / float(1024 ** len(SIZE_UNITS)), 1))
    for power in range(len(SIZE_UNITS) - 1, 0, -1):
        out = F.when(size < 1024 ** (power + 1), F.format_string(f"%.1f {SIZE_UNITS[power]}", F.bround(size / float(1024**power), 1))).otherwise(out)
    return F.when(size < 0, "-").when(size < 1024, F.format_string("%d B", size.cast("long"))).otherwise(out)


def leading_number(x: Column) -> Column:
    """The number that a text begins with, as a browser reads it, or 0."""
    found = F.regexp_extract(x, r"^\s*([-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?)", 1)
    return F.coalesce(F.nullif(found, F.lit("")).try_cast("double"), F.lit(0.0))


def id_line(title: Column, number: Column) -> Column:
    """A line of a catalogue, as parse_ids reads it."""
    return F.concat(title, F.lit(" = "), number.cast("string"))


def sampling_command(number: Column, match: str, rate: str = "1") -> Column:
    """The command that samples an issue's video to numbered images."""
    return F.concat(F.lit("ffmpeg -i video/av"), number.cast("string"), F.lit(f".mp4 -vf fps={rate} cache/f{match}_%06d.png"))


def axis_interval(labels: Column) -> Column:
    """How many labels apart an axis shows them: a tenth of their number, one at least."""
    return F.greatest(F.lit(1).cast("long"), F.floor(labels / 10))


# Fixed value: the link to the root.
ROOT_LINK = '<a href="/">根目录</a>'


def breadcrumb_html(path: Column) -> Column:
    """The parts of a relative path as links below the root; the last is the page itself."""
    item = lambda p: F.concat(
        F.lit('\n<span class="breadcrumb-sep">/</span>\n'),
        F.when(p["link"].isNull(), F.concat(F.lit('<span class="breadcrumb-current">'), p["name"], F.lit("</span>"))).otherwise(F.concat(F.lit('<a href="'), p["link"], F.lit('">'), p["name"], F.lit("</a>"))),
    )
    return F.concat(F.lit(ROOT_LINK), F.array_join(F.transform(breadcrumb(path), item), ""))


def filled(template: str, values: dict[str, Column]) -> Column:
    """A template with each placeholder replaced by its value, all at once: a value that holds a placeholder's text stays as it is. Null values are empty."""
    names = sorted(values, key=len, reverse=True)
    pieces, rest = [], template
    while rest:
        at, name = min(((i, n) for n in names if (i := rest.find(n)) >= 0), default=(len(rest), ""), key=lambda x: (x[0], -len(x[1])))
        pieces += [F.lit(rest[:at])] * (at > 0) + ([F.coalesce(values[name].cast("string"), F.lit(""))] if name else [])
        rest = rest[at + len(name) :]
    return F.concat(F.lit(""), *pieces)


def breadcrumb(path: Column) -> Column:
    """An array of (name, link) of the parts of a relative path; the last has no link."""
    parts = F.filter(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), lambda p: p != "")
    link = lambda p, i: F.when(i < F.size(parts) - 1, F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i + 1), "/"), F.lit("/")))
    return F.transform(parts, lambda p, i: F.struct(p.alias("name"), link(p, i).alias("link")))


# The grammars of recognised cells.
CELL_GRAMMARS = {
    "rank": r"\d+",
    "last": r"new!!|\d+ (up|down)",
    "count": r"\d{1,3}(,\d{3})*",
    "rate": r"\d+(\.\d+)?%",
    "factor": r"x\d+(\.\d+)?",
    "date": r"\d{4}年\d{2}月\d{2}日\d{2}:\d{2}:\d{2}",
    "id": r"(sm|nm|so)\d+",
}


def follows(x: Column, grammar: str) -> Column:
    return F.coalesce(x.rlike(f"^({CELL_GRAMMARS[grammar]})$"), F.lit(False))


def parsed_count(x: Column) -> Column:
    return F.replace(x, F.lit(","), F.lit("")).try_cast("long")
