"""Knowledge-base construction.

A document is one row, and all of its lines, sections, paragraphs and chunks are
array expressions inside that row: turning documents into chunks is a map-only job
with no shuffle, no Python and no window over lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import policy
from ticketloom.functions import text as X
from ticketloom.functions.scoring import context_minutes_sql

UPPER_LINE = r"\p{Lu}"
LOWER_LETTER = r"[\p{Ll}\p{Lt}]"


# --- file metadata -----------------------------------------------------------


def infer_doc_type(filename: Column) -> Column:
    return X.first_match(F.lower(filename), policy.DOC_TYPE_PATTERNS, policy.DEFAULT_DOC_TYPE)


def infer_kb_category(filename: Column) -> Column:
    return X.first_match(F.lower(filename), policy.KB_CATEGORY_PATTERNS, policy.DEFAULT_KB_CATEGORY)


def file_id(filename: Column) -> Column:
    bare = F.replace(filename, F.lit(".txt"), F.lit(""))
    return F.upper(F.replace(bare, F.lit(" "), F.lit("_")))


def doc_title(content: Column) -> Column:
    first_lines = F.transform(F.slice(F.split(content, "\n"), 1, 10), X.strip)
    usable = F.filter(
        first_lines,
        lambda s: (F.length(s) > 3) & ~s.startswith("===") & ~s.startswith("---"),
    )
    return F.coalesce(F.get(usable, F.lit(0)), F.lit("Untitled"))


def doc_identity(docs: DataFrame) -> DataFrame:
    """Add file_id, doc_title, doc_type and category."""
    return docs.withColumns({
        "file_id": file_id(F.col("filename")),
        "doc_title": doc_title(F.coalesce("content", F.lit(""))),
        "doc_type": infer_doc_type(F.col("filename")),
        "category": infer_kb_category(F.col("filename")),
    })


# --- lines and sections --------------------------------------------------------


def line_marks(content: Column) -> Column:
    """array<struct<line, text, blank, is_header, opens_section>> of a document.

    Each line becomes one letter: B blank, C header candidate, N other. A candidate
    opens a section unless the section so far is blank, so candidates alternate
    within a run, and at the start of the document the first one does not open.
    Two regular-expression replacements over the letters state exactly that.
    """

    def with_lines(lines: Column) -> Column:
        stripped = F.transform(lines, X.strip)
        return X.let(stripped, lambda s: letters_of(lines, s))

    def letters_of(lines: Column, s: Column) -> Column:
        def letter(x: Column, i: Column) -> Column:
            after = F.coalesce(F.get(s, i + 1), F.lit(""))
            caps = (
                x.rlike(UPPER_LINE)
                & ~x.rlike(LOWER_LETTER)
                & (F.length(x) > 5)
                & ~x.startswith("P1")
                & ~x.startswith("P2")
            )
            underlined = after.startswith("---") | after.startswith("===")
            return F.when(x == "", "B").when(caps | underlined, "C").otherwise("N")

        letters = F.array_join(F.transform(s, letter), "")
        return X.let(letters, lambda c: marks(lines, s, c))

    def marks(lines: Column, s: Column, c: Column) -> Column:
        opened = F.regexp_replace(c, "^(B*)C", "$1K")
        opened = F.regexp_replace(opened, "C(B*)C", "O$1K")
        opened = F.split(F.replace(opened, F.lit("C"), F.lit("O")), "")
        zipped = F.arrays_zip(
            lines.alias("line"), s.alias("text"), F.split(c, "").alias("letter"), opened.alias("opened")
        )
        return F.transform(
            zipped,
            lambda x: F.struct(
                x["line"].alias("line"),
                x["text"].alias("text"),
                (x["letter"] == "C").alias("is_header"),
                (x["opened"] == "O").alias("opens_section"),
            ),
        )

    return X.let(F.split(F.coalesce(content, F.lit("")), "\n"), with_lines)


def sections_of(content: Column) -> Column:
    """array<struct<title, content>>: text between opening headers, stripped."""

    def cut(m: Column) -> Column:
        opens = F.array_compact(
            F.transform(m, lambda x, i: F.when(x["opens_section"], i).otherwise(F.lit(None)))
        )
        return X.let(F.concat(F.array(F.lit(-1)), opens), lambda starts: bodies(m, starts))

    def bodies(m: Column, starts: Column) -> Column:
        def body(start: Column, i: Column) -> Column:
            end = F.coalesce(F.get(starts, i + 1), F.size(m))
            lines = F.transform(F.slice(m, start + 2, end - start - 1), lambda x: x["line"])
            untitled = F.when(F.size(starts) > 1, "Introduction").otherwise("Content")
            return F.struct(
                F.when(start < 0, untitled).otherwise(F.get(m, start)["text"]).alias("title"),
                X.strip(F.array_join(lines, "\n")).alias("content"),
            )

        return F.filter(F.transform(starts, body), lambda x: x["content"] != "")

    return X.let(line_marks(content), cut)


def detect_headers(docs: DataFrame) -> DataFrame:
    """One row per line: line_no, line, is_header, opens_section."""
    return docs.select("filename", F.posexplode(line_marks(F.col("content"))).alias("line_no", "m")).select(
        "filename", "line_no", "m.line", "m.is_header", "m.opens_section"
    )


def split_sections(docs: DataFrame) -> DataFrame:
    """One row per section: section_no, section_title, section."""
    return docs.select("filename", F.posexplode(sections_of(F.col("content"))).alias("section_no", "s")).select(
        "filename", "section_no", F.col("s.title").alias("section_title"), F.col("s.content").alias("section")
    )


# --- paragraphs and chunks -----------------------------------------------------


def paragraphs_of(section: Column, separator: str = "\n\n") -> Column:
    return F.filter(F.transform(F.split(section, separator), X.strip), lambda p: p != "")


def split_paragraphs(
    sections: DataFrame, separator: str = "\n\n", min_section: int = policy.MIN_SECTION
) -> DataFrame:
    """One row per paragraph of the sections of at least ``min_section`` characters."""
    return sections.filter(F.length("section") >= min_section).select(
        "filename",
        "section_no",
        F.posexplode(paragraphs_of(F.col("section"), separator)).alias("para_no", "paragraph"),
    )


FOLD = 256


def chunk_starts(
    lengths: Column, min_size: int = policy.MIN_CHUNK, max_size: int = policy.MAX_CHUNK,
    hard_max: int | None = None,
) -> Column:
    """Index of the first paragraph of every chunk.

    The buffer length counts two separator characters per paragraph. A full buffer
    closes before a paragraph that does not fit, unless it is still below
    ``min_size``; a short tail goes back to the chunk before it. ``hard_max`` closes
    a short buffer too when the paragraph would take it over that size.
    """

    def closes(a: Column, p: Column) -> Column:
        full = (a["size"] > 0) & (a["size"] + p > max_size) & (a["size"] >= min_size)
        if hard_max is not None:
            full = full | ((a["size"] > 0) & (a["size"] + p > hard_max))
        return full

    # Marks are gathered by runs of FOLD paragraphs: a mark is added to a short text, and a run to a short list.
    def folded_run(a: Column, run: Column) -> Column:
        one = F.aggregate(
            run,
            F.struct(a["size"].alias("size"), F.lit("").alias("marks")),
            lambda b, p: F.struct(
                (F.when(closes(b, p), p + 2).otherwise(b["size"] + p + 2)).alias("size"),
                F.concat(b["marks"], F.when(closes(b, p), "1").otherwise("0")).alias("marks"),
            ),
        )
        return X.let(one, lambda o: F.struct(o["size"].alias("size"), F.concat(a["marks"], F.array(o["marks"])).alias("marks")))

    runs = X.let(lengths, lambda x: F.transform(
        F.filter(F.sequence(F.lit(0), F.floor(F.size(x) / FOLD).cast("int")), lambda i: i * FOLD < F.size(x)), lambda i: F.slice(x, i * FOLD + 1, FOLD)))
    folded = F.aggregate(
        runs,
        F.struct(F.lit(0).alias("size"), F.array().cast("array<string>").alias("marks")),
        folded_run,
        lambda a: F.struct(a["size"].alias("size"), F.array_join(a["marks"], "").alias("marks")),
    )

    def starts(f: Column) -> Column:
        opened = F.array_compact(
            F.transform(
                F.split(f["marks"], ""),
                lambda x, i: F.when((i == 0) | (x == "1"), i).otherwise(F.lit(None)),
            )
        )
        return X.let(
            opened,
            lambda o: F.when(
                (F.size(o) > 1) & (f["size"] < min_size), F.slice(o, 1, F.size(o) - 1)
            ).otherwise(o),
        )

    return X.let(folded, starts)


def chunks_of(
    section: Column, separator: str = "\n\n",
    min_size: int = policy.MIN_CHUNK, max_size: int = policy.MAX_CHUNK, hard_max: int | None = None,
) -> Column:
    """array<string> of the packed chunks of a section."""

    def cut(paras: Column) -> Column:
        starts = chunk_starts(F.transform(paras, F.length), min_size, max_size, hard_max)
        return X.let(
            starts,
            lambda st: F.transform(
                st,
                lambda s, i: F.array_join(
                    F.slice(paras, s + 1, F.coalesce(F.get(st, i + 1), F.size(paras)) - s), "\n\n"
                ),
            ),
        )

    return X.let(paragraphs_of(section, separator), cut)


def pack_chunks(
    sections: DataFrame, min_size: int = policy.MIN_CHUNK, max_size: int = policy.MAX_CHUNK,
    min_section: int = policy.MIN_SECTION, hard_max: int | None = None,
) -> DataFrame:
    """One row per chunk: chunk_no (from 0, per section), chunk, char_count."""
    chunks = chunks_of(F.col("section"), "\n\n", min_size, max_size, hard_max)
    return (
        sections.filter(F.length("section") >= min_section)
        .select("filename", "section_no", F.posexplode(chunks).alias("chunk_no", "chunk"))
        .withColumn("char_count", F.length("chunk"))
    )


def extract_keywords(df: DataFrame, text_col: str, k: int = 10, out: str = "keywords") -> DataFrame:
    return df.withColumn(out, X.keywords(F.col(text_col), k))


def chunk_documents(
    docs: DataFrame,
    created_at: Column,
    min_section: int = policy.MIN_SECTION,
    min_size: int = policy.MIN_CHUNK,
    max_size: int = policy.MAX_CHUNK,
    hard_max: int | None = None,
) -> DataFrame:
    """Knowledge-base rows of (filename, content) documents.

    ``total_chunks`` counts chunks of the section, ``chunk_index`` and "(Part n)"
    count within the document. ``category``, ``filename``, ``content_hash`` and
    ``doc_total_chunks`` come on top of the nine table columns.
    """
    long_sections = F.filter(
        sections_of(F.col("content")), lambda s: F.length(s["content"]) >= min_section
    )

    def labelled(section: Column) -> Column:
        return X.let(
            chunks_of(section["content"], "\n\n", min_size, max_size, hard_max),
            lambda chunks: F.transform(
                chunks,
                lambda c: F.struct(
                    section["title"].alias("section_title"),
                    c.alias("content"),
                    F.size(chunks).alias("total_chunks"),
                ),
            ),
        )

    # Title and hash of the document go into the rows: a column beside an explode is worked out again for every row of it.
    document = F.struct(
        F.md5(F.encode(F.coalesce("content", F.lit("")), "utf-8")).alias("content_hash"),
        doc_title(F.coalesce("content", F.lit(""))).alias("doc_title"),
    )

    def numbered(chunks: Column, doc: Column) -> Column:
        return F.transform(
            chunks,
            lambda c, i: F.struct(
                (i + 1).alias("chunk_index"),
                F.size(chunks).alias("doc_total_chunks"),
                c["section_title"].alias("section_title"),
                c["content"].alias("content"),
                c["total_chunks"].alias("total_chunks"),
                doc["content_hash"].alias("content_hash"),
                doc["doc_title"].alias("doc_title"),
            ),
        )

    rows = X.let(F.flatten(F.transform(long_sections, labelled)), lambda chunks: X.let(document, lambda doc: numbered(chunks, doc)))
    exploded = docs.select("filename", F.explode(rows).alias("c"))
    doc_type = infer_doc_type(F.col("filename"))
    plain = F.concat(F.col("c.doc_title"), F.lit(" - "), F.col("c.section_title"))
    part = F.format_string("%s (Part %d)", plain, F.col("c.chunk_index"))
    return exploded.select(
        F.format_string("%s_%s_%03d", doc_type, file_id(F.col("filename")), F.col("c.chunk_index")).alias("doc_id"),
        doc_type.alias("doc_type"),
        F.when(F.col("c.total_chunks") == 1, plain).otherwise(part).alias("title"),
        F.col("c.content").alias("content"),
        X.keywords(F.col("c.content")).alias("keywords"),
        F.col("c.chunk_index").alias("chunk_index"),
        F.col("c.total_chunks").alias("total_chunks"),
        F.length("c.content").alias("char_count"),
        created_at.cast("timestamp").alias("created_at"),
        infer_kb_category(F.col("filename")).alias("category"),
        "filename",
        F.col("c.content_hash").alias("content_hash"),
        F.col("c.doc_total_chunks").alias("doc_total_chunks"),
    )


# --- labelled entries ------------------------------------------------------------


def extract_kb_entries(docs: DataFrame) -> DataFrame:
    """Labelled blocks of documents.

    A block is text between blank lines that either has a "Priority: Pn" line (its
    title is the line before) or a "Title (Priority Pn):" line.
    """
    lines = F.filter(F.transform(F.split("block", "\n"), X.strip), lambda s: s != "")
    labelled = r"^Priority: (P[1-4])"
    titled = r"^(.*\S) \(Priority (P[1-4])\):$"

    def at(pattern: str) -> Column:
        return F.array_min(
            F.transform(F.col("lines"), lambda s, i: F.when(s.rlike(pattern), i).otherwise(F.lit(None)))
        )

    def value_of(label: str) -> Column:
        hit = F.get(F.filter(F.col("lines"), lambda s: s.startswith(label)), F.lit(0))
        return X.strip(F.substr(hit, F.lit(len(label) + 1)))

    title_line = F.get(F.col("lines"), F.col("titled_at"))
    steps = F.transform(
        F.filter(
            F.col("lines"),
            lambda s: s.startswith("- ") & ~s.startswith("- Average resolution time"),
        ),
        lambda s: X.strip(F.substr(s, F.lit(3))),
    )
    blocks = docs.select(
        "filename",
        F.posexplode(F.split(F.coalesce("content", F.lit("")), r"\n\s*\n")).alias("block_no", "block"),
    ).filter(F.contains("block", F.lit("Priority")))
    placed = blocks.withColumn("lines", lines).withColumns(
        {"labelled_at": at(labelled), "titled_at": at(titled)}
    )
    return placed.filter("labelled_at > 0 OR titled_at IS NOT NULL").select(
        "filename",
        "block_no",
        F.when(F.col("titled_at").isNotNull(), F.regexp_extract(title_line, titled, 1))
        .otherwise(F.get(F.col("lines"), F.col("labelled_at") - 1))
        .alias("entry_title"),
        F.when(F.col("titled_at").isNotNull(), F.regexp_extract(title_line, titled, 2))
        .otherwise(F.regexp_extract(F.get(F.col("lines"), F.col("labelled_at")), labelled, 1))
        .alias("priority"),
        F.transform(
            F.split(F.coalesce(value_of("Affected Systems:"), F.lit("")), ","), X.strip
        ).alias("affected_systems"),
        steps.alias("steps"),
        F.expr(context_minutes_sql("block")).alias("avg_resolution_minutes"),
        value_of("Escalation:").alias("escalation"),
        F.col("block").alias("entry_text"),
    ).withColumn("affected_systems", F.filter("affected_systems", lambda s: s != ""))


# --- incremental loading -----------------------------------------------------------


def content_hash(content: Column) -> Column:
    return F.md5(F.encode(F.coalesce(content, F.lit("")), "utf-8"))


def new_doc_keys(docs: DataFrame, loaded: DataFrame) -> DataFrame:
    """(filename, content_hash) of documents not yet in ``loaded``; no content is shuffled."""
    keys = docs.select("filename", content_hash(F.col("content")).alias("content_hash"))
    return keys.join(loaded.select("filename", "content_hash"), ["filename", "content_hash"], "left_anti")


def select_new_docs(docs: DataFrame, loaded: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Documents whose (filename, content) is not yet in ``loaded``.

    ``loaded`` holds filename and content_hash; new and changed files pass. One join on
    both keys replaces per-file counting. With ``keys``, a staged ``new_doc_keys`` table,
    an incremental load broadcasts the few new keys and moves no other content.
    """
    hashed = docs.withColumn("content_hash", content_hash(F.col("content")))
    both = ["filename", "content_hash"]
    if keys is None:
        return hashed.join(loaded.select(both), both, "left_anti")
    return hashed.join(keys, both, "left_semi")


def match_doc_ids(kb: DataFrame, doc_type: Column, file_id: Column) -> DataFrame:
    """Count ids in the new ``<type>_<FILE>_n`` and the old ``<type>_nnn`` format."""
    prefix = F.concat(doc_type, F.lit("_"), file_id, F.lit("_"))
    old = F.col("doc_id").startswith(F.concat(doc_type, F.lit("_"))) & F.substr(
        "doc_id", F.length(doc_type) + 2
    ).rlike("^[0-9]{3}$")
    return kb.agg(
        F.count_if(F.col("doc_id").startswith(prefix)).alias("new_format"),
        F.count_if(old).alias("old_format"),
    )
