"""License scan by an exact set-similarity join of text blocks with templates.

A text is a row of words; blocks of ``BLOCK`` words overlap by the longest template less one word, so
every run of words as long as a template lies inside one block. A block matches a template if it
holds at least the template's share of its distinct words. Template words are ordered by their
frequency over all documents, rarest first. A template that needs m of its k words is looked up by
its first k - m + 1 words only (prefix filter); a block with too few template words is passed over
(length filter); and a shared word at place i allows at most the words from i on, in the template and
in the block, to be shared (positional filter). What passes is counted in full.

Phrases are templates with share 1 whose words must moreover stand in a row; the places are read
from the matching blocks. Both filters and counts are exact: no match is lost.

Scale: templates are a fixed short list, so their index is broadcast and the join needs no exchange.
The frequencies are counts per template word, added up from all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom.llm.common import map_batches, prepare, table

BLOCK = 64
#: Share of a template's words that a block must hold.
SHARE = 0.9
# fixed values: phrases and labels of the contract
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
TEMPLATES = (
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
)
_KEEP = bytes(i if i >= 0x80 or 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A else 0x20 for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of a-z, 0-9 and characters beyond ASCII, after A-Z became lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_KEEP).split()


class Index:
    """Templates with their words in global order, and the templates to try for each prefix word."""

    def __init__(self, phrases: Sequence, templates: Sequence, frequency: dict[bytes, int],
                 block: int = BLOCK, share: float = SHARE):
        self.rank = {w: i for i, w in enumerate(sorted(frequency, key=lambda w: (frequency[w], w)))}
        self.entries, self.by_word = [], {}
        for label, text, needed in [(*p, 1.0) for p in phrases] + [(*t, share) for t in templates]:
            row = words_of(text)
            ordered = sorted(set(row), key=self.rank.__getitem__)
            least = math.ceil(needed * len(ordered) - 1e-9)
            entry = (label, row, ordered, least, len(self.entries) < len(phrases))
            for i, w in enumerate(ordered[:len(ordered) - least + 1]):
                self.by_word.setdefault(w, []).append((len(self.entries), i))
            self.entries.append(entry)
        longest = max((len(e[1]) for e in self.entries), default=1)
        self.block = max(block, longest)
        self.step = self.block - longest + 1

    def scan(self, words: list[bytes]) -> tuple[list[tuple], list[tuple]]:
        """Matches (entry, start, stop, containment) and places (label, start)."""
        if self.by_word.keys().isdisjoint(words):
            return [], []
        rank, known = self.rank, [i for i, w in enumerate(words) if w in self.rank]
        found, places = [], set()
        starts = sorted({s for i, w in ((i, words[i]) for i in known) if w in self.by_word
                         for s in self._blocks_of(i, len(words))})
        low = 0
        for start in starts:
            stop = min(start + self.block, len(words))
            while known[low] < start:
                low += 1
            inside, at = set(), low
            while at < len(known) and known[at] < stop:
                inside.add(words[known[at]])
                at += 1
            ordered = sorted(inside, key=rank.__getitem__)
            tried: set[int] = set()
            for place, w in enumerate(ordered):
                for number, i in self.by_word.get(w, ()):
                    if number in tried:
                        continue
                    tried.add(number)
                    label, row, own, least, phrase = self.entries[number]
                    # w is the first common word, so no more than the words from here on are shared
                    if len(ordered) < least or 1 + min(len(own) - i - 1, len(ordered) - place - 1) < least:
                        continue
                    shared = sum(x in inside for x in own)
                    if shared < least:
                        continue
                    if phrase:
                        ends = stop - len(row) + 1
                        places.update((label, j) for j in known[low:at]
                                      if j < ends and words[j] == row[0] and words[j:j + len(row)] == row)
                    else:
                        found.append((number, start, stop, shared / len(own)))
        return found, sorted(places, key=lambda p: (p[1], p[0]))

    def _blocks_of(self, i: int, n: int) -> list[int]:
        """Starts of the blocks that hold word i; the last block is the first that reaches the end."""
        last = max(0, math.ceil((n - self.block) / self.step)) if n > self.block else 0
        high = min(i // self.step, last)
        out = []
        while high >= 0 and high * self.step + self.block > i:
            out.append(high * self.step)
            high -= 1
        return out


def template_frequencies(docs: DataFrame, entries: Sequence) -> dict[bytes, int]:
    """Number of documents that hold each template word, over all documents."""
    vocabulary = frozenset(w for _, text in entries for w in words_of(text))

    def make():
        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            seen: Counter = Counter()
            for text in rows.column(0).to_pylist():
                seen.update(vocabulary.intersection(words_of(text)))
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()),
                                               pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
        return batch
    counts = map_batches(docs.select("text"), make, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {w: 0 for w in vocabulary} | {bytes(r["word"]): r["n"] for r in counts.collect()}


MATCH = "array<struct<label:string,start:long,stop:long,containment:double>>"
PLACE = "array<struct<label:string,start:long,words:long>>"


def scan_licenses(docs: DataFrame, phrases: Sequence = PHRASES, templates: Sequence = TEMPLATES,
                  block: int = BLOCK, share: float = SHARE) -> DataFrame:
    """(doc_id, n_words, matches, places) of every row.

    matches: each block (words start to stop) and template that meet the share; places: each place
    of a phrase. A null text counts as empty: no words, no matches. Rows that repeat an id are
    answered one by one; extra columns are ignored; an empty table gives no rows.
    """
    index = docs.sparkSession.sparkContext.broadcast(
        Index(phrases, templates, template_frequencies(docs, [*phrases, *templates]), block, share))

    def make():
        own = index.value
        match = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
                                    ("containment", pa.float64())]))
        place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int64())]))
        length = {e[0]: len(e[1]) for e in own.entries if e[4]}

        def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
            n, matches, places = [], [], []
            for text in rows.column(1).to_pylist():
                words = words_of(text)
                found, at = own.scan(words)
                n.append(len(words))
                matches.append([{"label": own.entries[e][0], "start": a, "stop": b, "containment": c}
                                for e, a, b, c in found])
                places.append([{"label": label, "start": a, "words": length[label]} for label, a in at])
            return pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n, pa.int64()), pa.array(matches, match), pa.array(places, place)],
                names=["doc_id", "n_words", "matches", "places"])
        return batch
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), make,
                       f"doc_id {doc_type}, n_words long, matches {MATCH}, places {PLACE}")


def op8_licenses(spark, folder: str) -> DataFrame:
    """License digest of every whole text."""
    prepare(spark)
    found = scan_licenses(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.array_sort(F.array_distinct(F.col("places.label")))
    every = F.array_sort(F.array_distinct(F.concat(F.col("places.label"), F.col("matches.label"))))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(
            F.coalesce(F.array_max("matches.containment"), F.lit(0.0))).alias("score"))


def _statement() -> str:
    longest = max(len(words_of(t)) for _, t in (*PHRASES, *TEMPLATES))
    step = BLOCK - longest + 1
    named = lambda rows: ", ".join(f"('{label}', string_split('{text}', ' '))" for label, text in rows)
    return rf"""
with words as (
  select row_number() over () as rid, doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from documents),
phrases(label, p) as (values {named(PHRASES)}),
templates(label, t) as (values {named(TEMPLATES)}),
places as (
  select rid, label, i - 1 as start
  from (select rid, w, label, p, unnest(range(1, len(w) - len(p) + 2)) as i from words, phrases)
  where w[i] = p[1] and w[i:i + len(p) - 1] = p),
base as (
  select rid, count(*) as n_base, min(start) as first_word, max(start) as last_word,
         array_to_string(list_sort(list(distinct label)), ',') as base_labels from places group by rid),
blocks as (
  select rid, list_distinct(w[s + 1:s + {BLOCK}]) as b
  from (select rid, w, unnest(range(0, greatest(len(w) - {BLOCK} + {step} - 1, 0) + 1, {step})) as s from words)),
matches as (
  select rid, label, len(list_intersect(b, list_distinct(t)))::double / len(list_distinct(t)) as c
  from blocks, templates
  where len(list_intersect(b, list_distinct(t))) >= ceil({SHARE} * len(list_distinct(t)) - 1e-9)),
best as (select rid, max(c) as c from matches group by rid),
labelled as (
  select rid, array_to_string(list_sort(list(distinct label)), ',') as labels
  from (select rid, label from places union select rid, label from matches) group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
       case when n_base > 0 then 1.0::double else coalesce(c, 0.0::double) end as score
from words left join base using (rid) left join best using (rid) left join labelled using (rid)
"""


SQL = _statement()
