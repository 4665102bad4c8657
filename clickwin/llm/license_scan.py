"""License scans (operator 4).

Texts are read as words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z
lowered, joined by single spaces.  Exact phrases are the base.  For edited
notices a notice with ``k`` allowed edits is cut into ``k + 1`` pieces
(pigeonhole: one of them occurs unedited); the pieces are found together by
an Aho-Corasick automaton, and around each place the ``regex`` library's
bounded-error matching verifies the notice and gives its span.  What follows
a match in the same word, up to and with a typographic mark, counts as errors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwin.llm.common import batch_of, merged, utf8

#: Exact phrases and their labels (fixed values).
PHRASES = (("under the mit license", "mit"),
           ("apache license version 2", "apache-2"),
           ("cc by nc", "cc-by-nc"))

#: Notices searched with edits: label, text, edits allowed, words that have to
#: stand unedited because they tell one license from another (fixed values).
NOTICES = (("mit", "under the mit license", 2, ("mit",)),
           ("apache-2", "under the apache license version 2 0", 3, ("2",)),
           ("apache-2", "apache license version 2", 2, ("2",)),
           ("cc-by-nc", "licensed under cc by nc", 2, ("by", "nc")),
           ("gpl-3", "under the gnu general public license version 3", 4, ("3",)),
           ("gpl-2", "under the gnu general public license version 2", 4, ("2",)),
           ("mpl-2", "mozilla public license version 2", 3, ("2",)),
           ("bsd", "under the bsd license", 2, ("bsd",)),
           ("mit", "permission is hereby granted free of charge to any person obtaining a copy",
            6, ()))

# bytes that are no word bytes become spaces, A-Z become a-z
_CLEAN = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F
               else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
# the rest of a word with the marks that stick to it (only non-ASCII ones are left)
REST = re.compile(r"\w*[^\w ]*")
MARKS = re.compile(r"^[^\w ]+|[^\w ]+$")


@dataclass(frozen=True)
class Hit:
    label: str
    first_word: int
    last_word: int
    errors: int
    length: int


def split_pieces(text: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of nearly equal length with their offsets."""
    cut = [len(text) * i // (k + 1) for i in range(k + 2)]
    return [(a, text[a:b]) for a, b in zip(cut, cut[1:])]


class Scanner:
    """Finds notices with a bounded number of edits in normalised texts."""

    def __init__(self, notices=NOTICES):
        import ahocorasick
        self.notices = notices
        # \b: an edit may not turn into half a word at either end
        body = [rf"\b(?:{regex.escape(t)}){{e<={k}}}\b" for _, t, k, _ in notices]
        # the next match reads on from the last one; the best match looks at
        # all it is given, so it only sees the surroundings of the next one
        self.next = [regex.compile("(?e)" + p) for p in body]
        self.best = [regex.compile("(?b)" + p) for p in body]
        places: dict[str, list] = {}
        for n, (_, text, k, _) in enumerate(notices):
            for off, piece in split_pieces(text, k):
                places.setdefault(piece, []).append((n, off))
        self.seeds = ahocorasick.Automaton()
        for piece, at in places.items():
            self.seeds.add_word(piece, (len(piece), at))
        self.seeds.make_automaton()
        # cheap test first: a notice's unedited words, where it names any
        self.musts = [[w for w in must] for *_, must in notices]

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Merged candidate windows per notice around the exact seeds."""
        out: dict[int, list[list[int]]] = {}
        present = [all(w in text for w in must) for must in self.musts]
        for end, (length, at) in self.seeds.iter(text):
            for n, off in at:
                if not present[n]:
                    continue
                k, size = self.notices[n][2], len(self.notices[n][1])
                a = max(0, end - length + 1 - off - k - 1)
                b = a + size + 2 * k + 2
                mine = out.setdefault(n, [])
                if mine and mine[-1][0] <= a <= mine[-1][1]:
                    mine[-1][1] = max(mine[-1][1], b)
                else:
                    mine.append([a, b])
        return {n: merged(mine) for n, mine in out.items()}

    def matches(self, n: int, text: str, at: int, end: int) -> Iterator[tuple[regex.Match, int]]:
        """Matches of notice ``n`` in a window, left to right, with the
        characters left of their last word: the best one around every place
        that has one."""
        _, _, k, must = self.notices[n]
        while m := self.next[n].search(text, at, end):
            near = self.best[n].search(text, max(at, m.start() - k), min(end, m.end() + k + 1))
            at = m.end()
            for found in (near, m):
                if not found:
                    continue
                # the end of what was searched is not the end of a word
                rest = "" if found.group()[-1] == " " else REST.match(text, found.end()).group()
                if sum(found.fuzzy_counts) + len(rest) <= k:
                    got = [MARKS.sub("", w) for w in (found.group() + rest).split()]
                    if all(w in got for w in must):
                        at = max(at, found.end() + len(rest))
                        yield found, len(rest)
                        break

    def scan(self, text: str) -> list[Hit]:
        hits = []
        for n, spans in self.windows(text).items():
            label, notice = self.notices[n][:2]
            word = seen = 0             # word number at ``seen``; both only grow
            for a, b in spans:
                for m, rest in self.matches(n, text, a, min(b, len(text))):
                    start = m.start() + (m.group()[:1] == " ")
                    word, seen = word + text.count(" ", seen, start), start
                    hits.append(Hit(label, word, word + max(len(m.group().split()) - 1, 0),
                                    sum(m.fuzzy_counts) + rest, len(notice)))
        return sorted(set(hits), key=lambda h: (h.first_word, h.last_word, h.label, h.errors))


def clean_words(text: bytes | None) -> list[bytes]:
    return text.translate(_CLEAN).split() if text else []


def base_places(padded: bytes, phrases=PHRASES) -> list[tuple[int, str]]:
    """(start word, label) of every place of every phrase; ``padded`` is the
    words joined and enclosed by single spaces."""
    out = []
    for phrase, label in phrases:
        want = b" " + phrase.encode() + b" "
        word = seen = 0                 # word number at ``seen``
        while (at := padded.find(want, seen)) >= 0:
            word += padded.count(b" ", seen, at + 1)
            out.append((word - 1, label))
            seen = at + 1
    return out


def license_scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """License places of every whole text, one row per input row.

    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans``.  ``spans`` holds (label, first_word, last_word, errors) of
    the bounded-error matches.  ``score`` is 1 with an exact phrase, else the
    best match's ``1 - errors / length``, else 0.  A null or empty text has no
    words, null places and empty labels; repeated rows stay repeated.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    schema = (f"doc_id {id_type}, n_words bigint, n_base bigint, first_word bigint, "
              "last_word bigint, base_labels string, labels string, score double, spans array<"
              "struct<label:string,first_word:bigint,last_word:bigint,errors:int>>")
    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        scanner = Scanner(notices)
        for batch in batches:
            rows = []
            for text in utf8(batch, "t"):
                words = clean_words(text)
                joined = b" ".join(words)
                base = base_places(b" " + joined + b" ", phrases)
                hits = scanner.scan(joined.decode("utf-8", "replace"))
                mine = {label for _, label in base}
                score = 1.0 if base else max((1 - h.errors / h.length for h in hits), default=0.0)
                rows.append((len(words), len(base), min(base)[0] if base else None,
                             max(base)[0] if base else None, ",".join(sorted(mine)),
                             ",".join(sorted(mine | {h.label for h in hits})), score,
                             [{"label": h.label, "first_word": h.first_word,
                               "last_word": h.last_word, "errors": h.errors} for h in hits]))
            columns = list(zip(*rows)) if rows else [[]] * 8
            yield batch_of(arrow, batch.column("d"), *map(list, columns))

    return docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t")
                       ).mapInArrow(run, schema)
