"""Secrets: fixed patterns, and strings that known code and words do not explain.

A candidate is a long run of token characters soon after a sensitive word. Its novelty is the number of
bytes that zstandard adds for it after the text around it, primed with a dictionary of words and identifiers.
The dictionary is trained on the words of a given list and on those that recur in the texts, all of which are
counted whole. A candidate is reported if it adds as many bytes as a random string of its length over its own
alphabet does: the limits are measured once on random strings with the same compressor. Names, paths and
words are found in the dictionary or nearby and add less. A candidate does not explain its own repeats, and
what is reported explains nothing.

A text is read once: sensitive words, runs and known spans are walked side by side.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.frames import ship
from ticketloom.llm.wordarrays import map_texts

KINDS = ("assign", "access", "hex", "novel")

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
HINTS = ("password", "passwd", "secret", "token", "api")

SENSITIVE = re.compile(r"(?i:passw|pwd|secret|token|api_?key|access_?key|private_?key|credential|bearer|auth)", re.ASCII)
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}", re.ASCII)
REACH = 64  # characters from a sensitive word to the candidate
AROUND = 128  # characters on each side of a candidate that may explain it
SHORTEST, LONGEST, STEP = 16, 64, 8  # lengths that limits are measured at; beyond the last they grow with the length
MISSED = 0.05  # share of random strings that may stay below the limit
TRIALS = 40

RECURS = 1000  # a word recurs if one of so many texts has it, and two different ones at least
DICTIONARY_BYTES, DICTIONARY_SAMPLES, OFTENER, LEVEL = 524_288, 8000, 8, 3
WORD = r"[\p{L}\p{Nl}\p{No}]{3,}"

#: What code and settings say around keys.
COMMON = """import export return class function public static const string number boolean null true false default config configuration settings environment
variable value example placeholder changeme your key here password username secret token access private client id authorization bearer credential http https
localhost com www index html json yaml xml path file directory home user local bin etc var get set put post delete update create insert select from where order
group by limit offset join on table request response status message error warning info debug timestamp created at updated session identifier provider service
manager controller authentication authenticate authorized""".split()

#: Texts that limits are measured after; the compressor's choices vary with them, so the lowest result counts.
PLAIN = ("", "auth: ", "the credential is , thanks", "config.settings.environment = default; authorization: bearer  and 12 others",
         "and then the service answers with the access key  for the login of the staging area, which everyone in the team has to know before noon; ask again at 17:30",
         "x = { 'bearer': '', 'other': 3, 'list': [1, 20, 300], 'name': 'Example', 'path': '/home/user/local' } " * 2)


class Scanner:
    """The compressor with its dictionary, and the limits by alphabet and length."""

    def __init__(self, dictionary: bytes, limits: dict[int, list[float]] | None = None) -> None:
        self.dictionary = dictionary
        primed = zstandard.ZstdCompressionDict(dictionary)
        primed.precompute_compress(level=LEVEL)
        self.tool = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.limits = limits if limits is not None else {a: self._measured(a) for a in ALPHABETS}

    def added(self, around: str, candidate: str) -> int:
        """Bytes that the candidate adds to its compressed surroundings."""
        base = around.encode()
        return len(self.tool.compress(base + candidate.encode())) - len(self.tool.compress(base))

    def _measured(self, alphabet: int) -> list[float]:
        draw = random.Random(alphabet)
        letters = letters_of(alphabet)
        out = []
        for n in range(SHORTEST, LONGEST + 1, STEP):
            trials = ["".join(draw.choices(letters, k=n)) for _ in range(TRIALS)]
            out.append(float(min(sorted(self.added(plain, t) for t in trials)[int(MISSED * TRIALS)] for plain in PLAIN)))
        return out

    def limit(self, candidate: str) -> float:
        """The least added bytes for which a string of this alphabet and length is reported."""
        measured, n = self.limits[alphabet_of(candidate)], len(candidate)
        if n >= LONGEST:
            return measured[-1] * n / LONGEST
        k, rest = divmod(n - SHORTEST, STEP)
        return measured[k] + (measured[k + 1] - measured[k]) * rest / STEP if n > SHORTEST else measured[0]

    def random_like(self, around: str, candidate: str) -> bool:
        return self.added(around, candidate) >= self.limit(candidate)


# an alphabet is a sum: digits 1, small letters to f 2 or to z 6, capitals to F 8 or to Z 24, marks 32
ALPHABETS = [d + low + up + marks for d in (0, 1) for low in (0, 2, 6) for up in (0, 8, 24) for marks in (0, 32) if d + low + up + marks]
MARKS = "+/_=-"


def letters_of(alphabet: int) -> str:
    low, up = "abcdefghijklmnopqrstuvwxyz"[: 26 if alphabet & 4 else 6 if alphabet & 2 else 0], "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[: 26 if alphabet & 16 else 6 if alphabet & 8 else 0]
    return ("0123456789" if alphabet & 1 else "") + low + up + (MARKS if alphabet & 32 else "")


def alphabet_of(text: str) -> int:
    used = set(text)
    low, up = {c for c in used if "a" <= c <= "z"}, {c for c in used if "A" <= c <= "Z"}
    return (bool(used - low - up - set(MARKS)) + (6 if max(low, default="") > "f" else 2 if low else 0) + (24 if max(up, default="") > "F" else 8 if up else 0)
            + 32 * bool(used & set(MARKS)))


def trained(words: Iterable[str], own: Iterable[str] = ()) -> bytes:
    """A zstandard dictionary of words as identifiers, paths and plain text join them; `own` words come OFTENER. Equal words give equal bytes."""
    known = [*dict.fromkeys(words), *[*COMMON, *own] * OFTENER]
    draw = random.Random(len(known))

    def joined(k: int) -> str:
        own = draw.choices(known, k=draw.randint(2, 5))
        if k == 1:
            return own[0] + "".join(w[:1].upper() + w[1:] for w in own[1:])
        if k == 5:
            return "_".join(own).upper()
        return ("_", "", "/", "-", " ")[k].join(own)

    # sixteen words a sample at the least, so that every word of a long list has its turn
    rounds = max(DICTIONARY_SAMPLES, len(known) // 16)
    samples = [" ".join(joined(draw.randrange(6)) for _ in range(8)).encode() for _ in range(rounds)]
    return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=64, d=6, level=LEVEL).as_bytes()


def recurring_words(docs: DataFrame, text_col: str = "text") -> list[str]:
    """Words of three letters or more that at least one of `RECURS` texts has, and two different texts at least, in order.

    Every text is counted whole. Words that only copies of one text have do not recur. The driver gets as many words, those of
    most texts first, as the dictionary has bytes for.
    """
    text = F.col(text_col).cast("string")
    texts = docs.where(text.isNotNull()).select(text.alias("text"))
    words = texts.select(F.xxhash64("text").alias("h"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"), F.min("h").alias("low"), F.max("h").alias("high"))
    least = texts.count() / RECURS
    found = counted.where((F.col("low") < F.col("high")) & (F.col("n") >= least)).orderBy(F.col("n").desc(), "word")
    return sorted(r["word"] for r in found.select("word").limit(DICTIONARY_BYTES // 4).collect())


def learn(docs: DataFrame, text_col: str = "text", words: Iterable[str] = ()) -> Scanner:
    """A scanner for these texts: its dictionary has the given words and those that recur in the texts."""
    return Scanner(trained(words, recurring_words(docs, text_col)))


_SCANNERS: dict[str, Scanner] = {}


def restored(parts: tuple[bytes, dict[int, list[float]]]) -> Scanner:
    """The scanner of a worker process, made once."""
    name = hashlib.md5(parts[0]).hexdigest()
    if name not in _SCANNERS:
        _SCANNERS[name] = Scanner(*parts)
    return _SCANNERS[name]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns; each kind is matched leftmost and without overlap."""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def merged(spans: Iterable[tuple[int, ...]]) -> list[tuple[int, int]]:
    """The spans without overlaps, in order."""
    out: list[tuple[int, int]] = []
    for s, e, *_ in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def candidates(text: str, known: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Long runs of token characters soon after a sensitive word that overlap no known span (these are merged), left to right.

    A run that begins after the word counts whole; of a run that holds the word, what follows it.
    """
    out: list[tuple[int, int]] = []
    words = [m.end() for m in SENSITIVE.finditer(text)]
    w = k = 0
    for m in RUN.finditer(text) if words else ():
        s, e = m.span()
        while w < len(words) and words[w] + REACH < s:
            w += 1
        if w == len(words):
            break
        if words[w] > s:
            s = words[w]
        if s + SHORTEST > e:
            continue
        while k < len(known) and known[k][1] <= s:
            k += 1
        if k == len(known) or known[k][0] >= e:
            out.append((s, e))
    return out


def visible(text: str, low: int, high: int, hidden: list[tuple[int, int]]) -> str:
    """text[low:high] without the hidden spans, which are in order and apart."""
    out, at = [], low
    for s, e in hidden[bisect_right(hidden, low, key=lambda x: x[1]) : bisect_left(hidden, high, key=lambda x: x[0])]:
        out.append(text[at : max(at, s)])
        at = min(e, high)
    return "".join([*out, text[at:high]])


def novel_spans(scanner: Scanner, text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that the text around them and the dictionary do not explain; known and reported spans and own repeats are left out.

    A string reported once is reported wherever it is a candidate.
    """
    spans = merged(known)
    found = candidates(text, spans)
    verdicts: dict[str, bool] = {}
    news: list[tuple[int, int]] = []
    for s, e in found:
        token = text[s:e]
        if not verdicts.get(token):
            low, high = max(0, s - AROUND), min(len(text), e + AROUND)
            before = visible(text, low, s, merged([*near(spans, low, s), *near(news, low, s)]))
            around = (visible(text, e, high, spans) + " " + before).replace(token.strip(MARKS) or token, "")
            verdicts[token] = scanner.random_like(around, token)
        if verdicts[token]:
            news.append((s, e))
    return [(s, e, 3) for s, e in found if verdicts[text[s:e]]]


def near(spans: list[tuple[int, int]], low: int, high: int) -> list[tuple[int, int]]:
    """Those of ordered spans that overlap [low, high)."""
    return spans[bisect_right(spans, low, key=lambda x: x[1]) : bisect_left(spans, high, key=lambda x: x[0])]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: Iterable[str] = ()) -> DataFrame:
    """(id, spans array<struct<kind, start, end>>): code points, end exclusive, of every row.

    `words` go into the dictionary beside those that recur in the texts. A null or empty text has none. Repeated rows are
    scanned each; other columns are not read; an empty table gives none. Time grows with the length of a text, however many
    sensitive words, runs or keys it holds; a very long text is one task's work and is held in memory whole.
    """
    parts = shipped(docs, text_col, words)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, scanner = [], restored(parts.value)
        for text in batch.column(1).to_pylist():
            base = base_spans(text or "")
            spans = sorted(base + novel_spans(scanner, text or "", base), key=lambda s: (s[0], s[2]))
            rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, e, k in spans])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs.select(F.col(id_col).alias("id"), text_col), run,
                     f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>").withColumnRenamed("id", id_col)


def shipped(docs: DataFrame, text_col: str, words: Iterable[str]):
    """What a worker needs for its scanner, as a broadcast of some 530 KB."""
    scanner = learn(docs, text_col, words)
    ship(docs.sparkSession)
    return docs.sparkSession.sparkContext.broadcast((scanner.dictionary, scanner.limits))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]", words: Iterable[str] = ()) -> DataFrame:
    """The same rows and columns with every secret in the text replaced; null stays null. Rows and texts as in `find_secrets`."""
    parts = shipped(docs, text_col, words)

    def clean(text: str) -> str:
        base = base_spans(text)
        out, at = [], 0
        for s, e, _ in sorted(base + novel_spans(restored(parts.value), text, base)):
            if s >= at:
                out += [text[at:s], mark]
            at = max(at, e)
        return "".join([*out, text[at:]]) if out else text

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index(text_col)
        texts = pa.array([None if t is None else clean(t) for t in batch.column(at).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([texts if k == at else c for k, c in enumerate(batch.columns)], names=batch.schema.names)

    return map_texts(docs, run, docs.schema, text=docs.columns.index(text_col))


def secret_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: Iterable[str] = ()) -> DataFrame:
    """Counts of the base kinds, digest of the base spans and the list of all spans, per row."""
    found = find_secrets(docs, id_col, text_col, words)
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(id_col, count("assign"), count("access"), count("hex"), count("novel"),
                        F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
