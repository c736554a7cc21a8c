"""Catalogues, listings, review state, labelled data, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions import text as T
from frameloom.functions.names import unused
from frameloom.operators import substring

SNIPPED = "   ... snipped"


def parse_ids(df: DataFrame, line: str) -> DataFrame:
    """title, video_id of lines "title = id": split once, trimmed; blank lines and lines without "=" go."""
    parts = F.split(F.trim(F.col(line)), "=", 2)
    return df.where(F.trim(F.col(line)) != "").where(F.size(parts) == 2).withColumns({"title": F.trim(parts[0]), "video_id": F.trim(parts[1])})


def with_video(issues: DataFrame, videos: DataFrame, issue: str, video: str) -> DataFrame:
    """Issues with their video's number; an issue that videos doesn't have is an error."""
    found = issues.join(videos.select(issue, video), issue, "left")
    return found.withColumn(video, F.coalesce(video, F.raise_error(F.concat(F.lit("no video for issue "), F.col(issue).cast("string"))).cast(videos.schema[video].dataType)))


def titles_with(df: DataFrame, title: str, words: DataFrame, word: str) -> DataFrame:
    """Rows whose title contains a word, once for each such word, however many words there are."""
    return substring.texts_with(df, title, words, word)


def titles_without(df: DataFrame, title: str, word: str) -> DataFrame:
    return df.where(~F.contains(F.col(title), F.lit(word)))


def matching(df: DataFrame, name: str, is_dir: str, query: str, kind: str = "all") -> DataFrame:
    """Rows whose name contains the query in any case, and are of that kind (all, dir, file)."""
    found = F.contains(F.lower(F.col(name)), F.lit(query.lower()))
    return df.where(found if kind == "all" else found & (F.col(is_dir) == (kind == "dir")))


def listing_order(is_dir: str, name: str) -> list[Column]:
    return [F.col(is_dir).desc(), F.lower(F.col(name)).asc(), F.col(name).asc()]


def listing_counts(df: DataFrame, keys: list[str], is_dir: str, has_parent: bool) -> DataFrame:
    dirs, files = F.count_if(F.col(is_dir)), F.count_if(~F.col(is_dir))
    return df.groupBy(*keys).agg(dirs.alias("dirs"), files.alias("files"), (dirs + files + int(has_parent)).alias("total"))


# Classes, letters and words of a listing's rows.
KINDS = {True: ("file-type-dir", "D", "打开"), False: ("file-type-file", "F", "查看")}


# Fixed values in it: the markup of a row.
def _cells(href: Column, kind: Column, letter: Column, shown: Column, size: Column, stamp: Column, action: Column) -> Column:
    texts = ['<tr><td class="col-name"><a href="', href, '" class="file-link"><span class="file-type ', kind, '">', letter, "</span><span>", shown, '</span></a></td><td class="col-size">', size, '</td><td class="col-mtime">', stamp, '</td><td class="col-action">', action, "</td></tr>"]
    return F.concat(*(F.lit(x) if isinstance(x, str) else x for x in texts))


def listing_parent() -> Column:
    """The row that leads to the folder above."""
    return _cells(*map(F.lit, ("../", *KINDS[True][:2], "..", "-", "-", "")))


def listing_rows(df: DataFrame, keys: list[str], name: str, is_dir: str, size: str, time: str, has_parent: Column | None = None) -> DataFrame:
    """keys, html: a folder's listing as table rows, the parent first if it has one, then directories, then files, by name in any case.

    Columns: name with its kind, size, time, action; directories have no size and time. A folder's entries are its result, one text.
    """
    of = lambda k: F.when(F.col(is_dir), KINDS[True][k]).otherwise(KINDS[False][k])
    href = T.html_escape(F.concat(F.col(name), F.when(F.col(is_dir), "/").otherwise("")))
    shown = F.when(F.col(is_dir), "-").otherwise(T.human_size(F.col(size)))
    stamp = F.when(F.col(is_dir), "-").otherwise(F.coalesce(F.date_format(F.col(time), "yyyy-MM-dd HH:mm"), F.lit("-")))
    action = F.concat(F.lit('<a href="'), href, F.lit('" class="btn btn-text">'), of(2), F.lit("</a>"))
    item = F.struct((~F.col(is_dir)).alias("file"), F.lower(F.col(name)).alias("low"), F.col(name).alias("name"), _cells(href, of(0), of(1), T.html_escape(F.col(name)), shown, stamp, action).alias("row"))
    up = listing_parent()
    rows = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["row"])
    parent = F.lit(False) if has_parent is None else F.bool_or(has_parent)
    return df.groupBy(*keys).agg(F.array_join(F.concat(F.when(parent, F.array(up)).otherwise(F.array().cast("array<string>")), rows), "\n").alias("html"))


# The placeholders of an index page, and its title and description with and without a folder's name.
TITLE, DESCRIPTION, BREADCRUMB, FILE_ROWS, TOTAL_COUNT, DIR_COUNT, FILE_COUNT = "__TITLE__", "__DESCRIPTION__", "__BREADCRUMB__", "__FILE_ROWS__", "__TOTAL_COUNT__", "__DIR_COUNT__", "__FILE_COUNT__"
PAGE_TITLE, PAGE_TITLE_OF, ROOT_DESCRIPTION, DESCRIPTION_OF = "文件索引", "文件索引 — ", "根目录", "目录 "


def index_pages(folders: DataFrame, entries: DataFrame, folder: str, name: str, is_dir: str, size: str, time: str, template: str) -> DataFrame:
    """folder, html: the index page of each folder (a path relative to the root, which is ""), a template whose placeholders are filled in.

    entries are the folders' files and folders by the folder that they are in, as read_listing tells them. A folder without entries has a page too; all but the root have a row for the parent.
    """
    parent = F.col(folder) != ""
    rows = listing_rows(entries, [folder], name, is_dir, size, time, parent)
    counts = listing_counts(entries, [folder], is_dir, False)
    alone = listing_parent()
    told = folders.select(folder).distinct().join(rows, folder, "left").join(counts, folder, "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return told.select(folder, T.filled(template, {
        TITLE: F.when(parent, F.concat(F.lit(PAGE_TITLE_OF), folder)).otherwise(PAGE_TITLE), DESCRIPTION: F.when(parent, F.concat(F.lit(DESCRIPTION_OF), folder)).otherwise(ROOT_DESCRIPTION),
        BREADCRUMB: T.breadcrumb_html(F.col(folder)), FILE_ROWS: F.coalesce("html", F.when(parent, alone)), TOTAL_COUNT: n("total") + F.when(parent, 1).otherwise(0), DIR_COUNT: n("dirs"), FILE_COUNT: n("files"),
    }).alias("html"))


def review_counts(df: DataFrame, keys: list[str], low_quality: Column, deleted: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(low_quality).alias("synthesized"), F.count_if(deleted).alias("deleted"))


def review_view(df: DataFrame, view: str, low_quality: Column, deleted: Column) -> DataFrame:
    """The rows of a view: all, synthesized, deleted."""
    return df.where({"all": F.lit(True), "synthesized": low_quality, "deleted": deleted}[view])


def moved_cursor(cursor: Column, step: Column, n: Column) -> Column:
    """The frame after a step, round and round."""
    return F.pmod(cursor + step, n)


def representative_index(frames: Column, representative: Column) -> Column:
    """Where the representative stands among the frames, from 0; 0 if it doesn't."""
    return F.greatest(F.coalesce(F.array_position(frames, representative) - 1, F.lit(0)), F.lit(0))


def image_url(frame: Column, purified: Column) -> Column:
    return F.concat(F.when(purified, "/cache/purified/").otherwise("/cache/frames/"), frame)


def labelled_files(marks: DataFrame, url: str, label: Column, files: DataFrame, name: str) -> DataFrame:
    """Marks with a label whose file exists: a left-semi join, so a file listed twice doesn't double its mark."""
    named = marks.withColumn(name, T.file_name(F.col(url))).withColumn("label", label).where(F.col("label").isNotNull())
    return named.join(files.select(name), name, "left_semi")


def log_sections(df: DataFrame, keys: list[str], order: str, line: str, header: Column, passing: Column) -> DataFrame:
    """Add section (number of headers so far), is_header and passed (true from the first passing line on).

    Empty lines are left out. Running sums over each log; a log is one sequence.
    """
    df = df.where(F.col(line) != "")
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = F.max(F.coalesce(passing, F.lit(False)).cast("int")).over(w) == 1
    flagged = df.withColumn("passed", passed).withColumn("is_header", F.coalesce(header, F.lit(False)) & ~F.col("passed"))
    return flagged.withColumn("section", F.sum(F.col("is_header").cast("int")).over(w))


def log_snip(sections: DataFrame, keys: list[str], order: str, line: str, number: Column, low: int, high: int) -> DataFrame:
    """keys, section, pos, out of the lines that stay.

    Of a section the lines whose number lies in low ... high stay, with its header and a marker where lines before or
    after them are gone; of a section without such a line nothing does. Lines before all headers and passed ones stay.
    """
    inside = F.coalesce(number.between(low, high), F.lit(False)) & ~F.col("is_header")
    body = (F.col("section") > 0) & ~F.col("passed")
    w = Window.partitionBy(*keys, "section", "passed")
    at = lambda f, c: f(F.when(c, F.col(order))).over(w)
    text = ~F.col("is_header")
    held, inner, first, last, least, most = unused(sections, "held", "inner", "first", "last", "least", "most")
    marked = sections.withColumns({held: inside, inner: body, first: at(F.min, inside), last: at(F.max, inside), least: at(F.min, text), most: at(F.max, text)})
    gap = F.struct(F.lit(SNIPPED).alias("out"), F.lit(1).alias("pos"))
    own = F.struct(F.col(line).alias("out"), F.lit(2).alias("pos"))
    after = F.struct(F.lit(SNIPPED).alias("out"), F.lit(3).alias("pos"))
    none = F.lit(None).cast("struct<out:string,pos:int>")
    before_gap = F.when(F.col(inner) & (F.col(order) == F.col(first)) & (F.col(first) > F.col(least)), gap).otherwise(none)
    after_gap = F.when(F.col(inner) & (F.col(order) == F.col(last)) & (F.col(last) < F.col(most)), after).otherwise(none)
    stays = ~F.col(inner) | F.col(held) | (F.col("is_header") & F.col(first).isNotNull())
    parts = F.filter(F.array(before_gap, F.when(stays, own).otherwise(none), after_gap), lambda x: x.isNotNull())
    return marked.select(*keys, "section", order, F.explode(parts).alias("part")).select(*keys, "section", F.col(order), "part.pos", "part.out")
