"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    raw = (text or "").encode()
    if lower:
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    return WORD.findall(raw)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def fold(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def base_counts(text):
    w = words(text)
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dups += line in seen
            seen.add(line)
    grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + o for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for o in range(3)}
    return len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text or "")), dups, len(covered)


def shingles(text):
    w = words(text, lower=True)
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def near_components(rows):
    """component of each row's index: smallest id reachable."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    out = []
    for i in range(len(rows)):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        out.append(min(group) if None not in group else None)
    return sets, out


def without_repeats(rows):
    """(n_words, n_removed, kept words joined) of each row, by (id, place of reading); null ids last."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    seen, out = set(), {}
    for k in order:
        w = words(rows[k][1])
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            run = tuple(w[i : i + 20])
            if run in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(run)
        out[k] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g))
    return [out[k] for k in range(len(rows))]


def unigram_scores(rows, learned):
    counts = Counter()
    tokens = [words(t, lower=True) + [None] for _, t in rows]
    for k, w in enumerate(tokens):
        if learned[k]:
            counts.update(w)
    total, kinds = sum(counts.values()), len(counts)
    return total, [(len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w)) for w in tokens]


def least_padding(lengths, buckets):
    """Padding of the best choice of widths, by trying all choices."""
    from itertools import combinations

    size = sorted(lengths)
    if not size:
        return 0
    best = None
    for n in range(min(buckets, len(size))):
        for cut in combinations(size[:-1], n):
            widths = sorted([*cut, size[-1]])
            pad = sum((next(w for w in widths if w >= s) - s) * lengths[s] for s in size)
            best = pad if best is None else min(best, pad)
    return best


def longest_match_phrases(text, known):
    """Greedy phrases of text, each the longest prefix of the rest that `known` has as a substring (one letter at least)."""
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in known:
            size += 1
        n, at = n + 1, at + size
    return n


# --- secrets: the fixed patterns, from the contract's words ---------------------------------------


def base_spans(text):
    """(start, end, kind) by hand-written scans: each kind leftmost, without overlap, failing matches dropped."""
    out = []
    keys = ("password", "passwd", "secret", "token", "api_key", "apikey")
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)

    def spaces(k):
        while k < len(text) and text[k] == " ":
            k += 1
        return k

    def assigned(at, word):
        """End of group 2 and of the match, trying the optional marks as a regular expression would."""
        k = at + len(word)
        for a in ((k + 1, k) if k < len(text) and text[k] in "\"'" else (k,)):
            b = spaces(a)
            if b < len(text) and text[b] in ":=":
                c = spaces(b + 1)
                for d in ((c + 1, c) if c < len(text) and text[c] in "\"'" else (c,)):
                    e = d
                    while e < len(text) and text[e] in value:
                        e += 1
                    if e > d:
                        return d, e
                # fewer spaces after the sign leave nothing that a value may begin with
        return None

    k = 0
    while k < len(text):
        hit = next((m for w in keys if low.startswith(w, k) and (m := assigned(k, w))), None)
        if hit:
            if hit[1] - hit[0] >= 6:
                out.append((k, hit[1], 0))
            k = hit[1]
        else:
            k += 1
    for kind, head, letters, least in ((1, "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20), (2, "", set("0123456789abcdef"), 24)):
        k = 0
        while k < len(text):
            e = k + len(head)
            if text.startswith(head, k):
                while e < len(text) and text[e] in letters:
                    e += 1
                if e > k + len(head):
                    if e - k >= least:
                        out.append((k, e, kind))
                    k = e
                    continue
            k += 1
    return sorted(out, key=lambda s: (s[0], s[2]))


# --- language model: a plain walk -----------------------------------------------------------------


class BackoffModel:
    """Interpolated absolute discounting over one to three tokens with dictionaries; `spelling` gives log10 p of a token's letters."""

    def __init__(self, texts, spelling):
        self.counts = [Counter(), Counter(), Counter()]
        self.spelling = spelling
        for w in texts:
            run = [None, None, *w, None]
            for k in range(2, len(run)):
                for n in range(3):
                    self.counts[n][tuple(run[k - n : k + 1])] += 1
        self.context = [Counter(), Counter(), Counter()]
        self.follow = [Counter(), Counter(), Counter()]
        for n in range(3):
            for run, c in self.counts[n].items():
                self.context[n][run[:-1]] += c
                self.follow[n][run[:-1]] += 1
        self.discount = []
        for c in self.counts:
            n1, n2 = (sum(x == m for x in c.values()) for m in (1, 2))
            self.discount.append(min(max(n1 / (n1 + 2 * n2), 0.1), 0.95) if n1 + n2 else 0.5)

    def p(self, run):
        """Probability of the last token of a run of one to three after the others."""
        n, h = len(run) - 1, run[:-1]
        below = self.p(run[1:]) if n else 10 ** self.spelling(run[0])
        total = self.context[n][h]
        if not total:
            return below
        return max(self.counts[n][run] - self.discount[n], 0) / total + self.discount[n] * self.follow[n][h] / total * below

    def score(self, w):
        run = [None, None, *w, None]
        return sum(math.log10(self.p(tuple(run[k - 2 : k + 1]))) for k in range(2, len(run)))


# --- conversations, mixing, spelling --------------------------------------------------------------


def trie(rows):
    """{(conv_id, depth): row} of the contract's nodes, from (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            key = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), key, (role or "", text or "")))
    own = {c: [x[2] for x in sorted(t)] for c, t in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    members = {}
    for c, x in rebuilt.items():
        for d in range(len(x) + 1):
            members.setdefault(tuple(x[:d]), []).append(c)
    children = Counter(n[:-1] for n in members if n)
    saved, leaves = Counter(), Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1].encode()) if n else 0
            leaves[n[:d]] += not children[n]
    return {(min(m), len(n)): (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n],
                               sha(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(n)).encode())) for n, m in members.items()}


def mix_targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target} of {source: words}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        wide = sum(weight[s] for s in order if s not in capped)
        target = {s: most * sizes[s] if s in capped else rest * weight[s] / wide for s in order}
        more = {s for s in order if s not in capped and target[s] > most * sizes[s]}
        if not more:
            return target
        capped |= more


def vocabulary(rows):
    """{word: n} from (doc_id, text)."""
    out = Counter()
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 6:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 5}


def variants(counts):
    """{word: (form, root, n, n_near, form_n)}."""
    letters = sorted({c for w in counts for c in w})

    def near(w):
        cut = {w[:k] + w[k + 1 :] for k in range(len(w))}
        put = {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in letters}
        new = {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in letters}
        return [v for v in (cut | put | new) - {w} if v in counts]

    form, out = {}, {}
    for w in counts:
        n = near(w)
        best = min(n, key=lambda v: (-counts[v], v), default=None)
        form[w] = (best if best is not None and counts[best] >= 5 * counts[w] else None, len(n))
    for w in counts:
        root = w
        while form[root][0] is not None:
            root = form[root][0]
        out[w] = (form[w][0], root, counts[w], form[w][1], counts[form[w][0]] if form[w][0] else None)
    return out


# --- piecewise fingerprints, byte by byte ---------------------------------------------------------

FULL = (1 << 64) - 1
STEP = 0x9E3779B97F4A7C15


def spread(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & FULL
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & FULL
    return x ^ (x >> 31)


def fingerprint(data):
    """size:signature:signature: pieces end where the hash of the last seven bytes is -1 modulo the size; 64 letters at most."""
    codes = [spread((b + 1) * STEP & FULL) for b in range(256)]
    rolls = []
    for k in range(len(data)):
        total = 0
        for b in data[max(0, k - 6) : k + 1]:
            total = (total * STEP + codes[b]) & FULL
        rolls.append(spread(total) >> 32)

    def signature(size):
        out, piece = [], []
        for k, b in enumerate(data):
            piece.append(b)
            if (rolls[k] % size == size - 1 and len(out) < 63) or k == len(data) - 1:
                total = 0
                for x in reversed(piece):
                    total = (total * STEP + codes[x]) & FULL
                out.append("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"[spread((total + len(piece)) & FULL) & 63])
                piece = []
        return "".join(out)

    if not data:
        return "3::"
    size = 3
    while size * 56 < len(data):
        size *= 2
    while len(signature(size)) < 28 and size > 3:
        size //= 2
    return f"{size}:{signature(size)}:{signature(2 * size)}"
