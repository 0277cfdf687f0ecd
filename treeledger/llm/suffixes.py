"""Removal of passages that repeat across documents, by a sparse suffix array.

Of all suffixes (from every word to the end of the text) only those at minimisers are kept: in every
window of ``least`` words, the run of ``run`` words with the smallest hash. Equal windows choose the
same place, so whatever two documents share over ``least`` words or more has a kept suffix in both.

The suffixes are sorted by range on their first ``run`` words, the words themselves, and then by
document. Rows stream by in that order and each is compared with its neighbour: suffixes that start alike
are a run, and a run in which a neighbour is of another document is a repeat. A run may go on over the
border of a partition; the first and the last run of each partition are put together afterwards, from a
table of two rows per partition at most. All others are settled as they pass, and those without a repeat
go no further.

Matches are then extended to the left and right, as far as the windows reach that chose this suffix:

* Each suffix carries a 64-bit digest of all the words its windows cover. Where all of a run, who start
  alike, agree in it, they match to both ends.
* Where they differ, the extension is made one word at a time: every window of these suffixes is
  compared.

Windows that documents share are joined to spans. A span stays in the document with the smallest id
and is cut from the others. A shared passage is therefore found to the word, and none of fewer than
``least`` words is touched. Repeats inside one document only are not looked for.

A passage may be in a third of all documents: the range sort cuts its run wherever the balance asks for
it, groups are only ever counted (which combines before the shuffle) and joined with one row per group
(which the skew join splits). Suffixes are compared by their words, windows by 128-bit digests of their
words. In both, a word of over 64 bytes stands as its SHA-256, so that rows stay small.

Defined results: null, empty and short texts (under ``least`` words) have no spans. Rows that repeat
with id and text are one document. Rows that share an id but not the text are one document as to where
a passage stays, but cut each by its own spans. Rows with a null id are documents of their own, told apart by
their texts, and come after all others (ids from 2 to the 62nd on are theirs). No rows give no spans.
Other columns are carried by ``cut_repeats`` and ignored else.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from treeledger.llm.text import text_of
from treeledger.sources.store import stored

LEAST = 50
RUN = 10
FIRST_NULL_ID = 2**62


def _tools(least: int, run: int):
    """A function that makes what texts are cut and compared with. It is called in each task, so that
    executors need no copy of this module."""

    def made():
        from hashlib import sha256

        import numpy as np
        from xxhash import xxh3_128_digest, xxh64_intdigest

        base = 0x9E3779B97F4A7C15

        def mixed(h):
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            return h ^ (h >> np.uint64(29))

        def cut(text):
            """The words one after another, with a space between them, and where each begins; nothing
            for a text of fewer than ``least`` words."""
            words = text.encode("utf-8", "replace").split()
            if len(words) < least:
                return None
            words = [w if len(w) <= 64 else b"\x01" + sha256(w).hexdigest().encode() for w in words]
            places = np.zeros(len(words) + 1, np.int64)
            np.cumsum([len(w) + 1 for w in words], out=places[1:])
            return words, b" ".join(words), places.tolist()

        def chosen(words):
            """The places of the smallest runs, and the first and last window that chose each."""
            hashes = mixed(np.array([xxh64_intdigest(w) for w in words], np.uint64))
            n = len(words) - run + 1
            runs = np.zeros(n, np.uint64)
            for k in range(run):
                runs = runs * np.uint64(base) + hashes[k : k + n]
            view = np.lib.stride_tricks.sliding_window_view(mixed(runs), least - run + 1)
            place = view.argmin(axis=1) + np.arange(len(view))
            first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            last = np.concatenate((first[1:], [len(place)])) - 1
            return place[first], first, last

        def digests(pieces):
            """Two 64-bit halves of a digest of each piece."""
            return np.frombuffer(b"".join(map(xxh3_128_digest, pieces)), "<i8").reshape(-1, 2)

        return cut, chosen, digests

    return made


def _suffix_rows(docs: DataFrame, least: int, run: int) -> DataFrame:
    """The kept suffixes: ``head``, the first words, ``whole``, a digest of all that the suffix's windows
    ``first`` to ``last`` cover, and the document."""
    make = _tools(least, run)

    def task(batches):
        import numpy as np
        import pandas as pd

        cut, chosen, digests = make()
        names = ["head", "whole", "doc", "digest", "first", "last"]

        def frame(out):
            heads = [h for row in out for h in row[0]]
            rest = map(np.concatenate, zip(*(row[1:] for row in out)))
            return pd.DataFrame(dict(zip(names, [heads, *rest])))

        for batch in batches:
            out, held = [], 0
            for doc, digest, text in zip(batch["doc"].tolist(), batch["digest"].tolist(), batch["text"]):
                found = cut(text)
                if found is None:
                    continue
                words, line, at = found
                place, first, last = chosen(words)
                n = len(place)
                # Where in the covered words the place is, belongs to what is compared.
                whole = digests(
                    b"%d " % (p - f) + line[at[f] : at[z + least] - 1]
                    for p, f, z in zip(place.tolist(), first.tolist(), last.tolist())
                )
                heads = [line[at[p] : at[p + run] - 1].decode("utf-8") for p in place.tolist()]
                out.append((
                    heads, whole[:, 0], np.full(n, doc), np.full(n, digest),
                    first.astype(np.int32), last.astype(np.int32),
                ))
                held += n
                if held > 50_000:
                    yield frame(out)
                    out, held = [], 0
            if out:
                yield frame(out)

    return docs.mapInPandas(
        task, "head string, whole bigint, doc bigint, digest bigint, first int, last int"
    )


def _compared(suffixes: DataFrame) -> DataFrame:
    """Suffixes in order, each compared with the one before it; those go on whose run has a suffix of
    another document, or may have it beyond the partition's border.

    ``(run_id, first_doc, whole, doc, digest, first, last)``: ``run_id`` is the same for
    suffixes of a partition that start alike, ``first_doc`` the smallest document of them there. Beside
    them, a row with ``head`` (null in the others) and ``last_doc`` tells of the first and of the last run
    of each partition. Rows are held only while a run has shown no second document: the suffixes of one
    document that start alike.
    """
    order = ["head", "doc", "digest", "first"]

    def task(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        carried = ["whole", "doc", "digest", "first", "last"]
        kinds = [pa.int64()] * 3 + [pa.int32()] * 2
        names = ["run_id", "first_doc", *carried, "head", "last_doc"]

        def batch_of(run, first_doc, columns):
            n = len(run)
            arrays = [pa.array(run), pa.array(first_doc), *columns, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        # Of the run that goes on: its words, number, first document, whether it has a second one, and the
        # rows that wait for that; of the row before, all that makes it equal to a repeated one.
        head, number, first_doc, repeated, waiting, before = None, None, None, False, [], None
        opening = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            heads = batch.column("head")
            doc, digest, first = (batch.column(c).to_numpy() for c in ("doc", "digest", "first"))
            new, twin = np.ones(n, bool), np.zeros(n, bool)
            new[1:] = pc.not_equal(heads[1:], heads[:-1]).to_numpy(zero_copy_only=False)
            twin[1:] = (doc[1:] == doc[:-1]) & (digest[1:] == digest[:-1]) & (first[1:] == first[:-1])
            start = heads[0].as_py()
            new[0] = start != head
            if number is None:
                base = int(batch.column("part")[0].as_py()) << 40
                number, opening = base - 1, {"head": start, "first_doc": int(doc[0])}
            else:
                twin[0] = before == (doc[0], digest[0], first[0])
            run = number + np.cumsum(new)
            begins = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            least_doc = np.where(begins >= 0, doc[begins], 0 if first_doc is None else first_doc)
            # Which runs of this batch have a second document, here or already before.
            low = int(run[0])
            several = np.zeros(int(run[-1]) - low + 1, bool)
            several[(run - low)[doc != least_doc]] = True
            if not new[0]:
                several[0] |= repeated
            if not new[0] and several[0]:
                yield from waiting
            if new[0] or several[0] or run[-1] != low:
                waiting = []
            known = several[run - low] | (run == base)
            once = new | ~twin
            columns = [batch.column(c) for c in carried]
            goes, waits = known & once, ~known & once & (run == run[-1])
            if goes.any():
                yield batch_of(run[goes], least_doc[goes], [c.filter(pa.array(goes)) for c in columns])
            if waits.any():
                waiting.append(batch_of(run[waits], least_doc[waits], [c.filter(pa.array(waits)) for c in columns]))
            in_opening = doc[run == base]
            if len(in_opening):
                opening["last_doc"] = int(in_opening[-1])
            head, number = heads[n - 1].as_py(), int(run[-1])
            first_doc, repeated = int(least_doc[-1]), bool(several[-1])
            before = (doc[-1], digest[-1], first[-1])
        if number is None:
            return
        yield from waiting
        ends = [(base, opening["first_doc"], opening["head"], opening["last_doc"])]
        if number != base:
            ends.append((number, first_doc, head, int(before[0])))
        run, least_doc, words, last_doc = zip(*ends)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(run, pa.int64()), pa.array(least_doc, pa.int64()),
                *(pa.nulls(len(ends), kind) for kind in kinds),
                pa.array(words, pa.string()), pa.array(last_doc, pa.int64()),
            ],
            names=names,
        )

    rows = (
        suffixes.repartitionByRange(*order)
        .withColumn("part", F.spark_partition_id())
        .sortWithinPartitions(*order)
    )
    return rows.mapInArrow(
        task,
        "run_id bigint, first_doc bigint, whole bigint, doc bigint, digest bigint, first int, last int, "
        "head string, last_doc bigint",
    )


def _matched(suffixes: DataFrame) -> DataFrame:
    """``(run_id, first_doc, whole, doc, digest, first, last)``: suffixes that start like one of
    another document; ``first_doc`` is the smallest document of the whole run."""
    compared = stored(_compared(suffixes), "compared")
    run = Window.partitionBy("head")
    # Two rows for each partition at most.
    borders = compared.where("head is not null").select(
        F.col("run_id").alias("_run"),
        F.min("run_id").over(run).alias("_whole"),
        F.min("first_doc").over(run).alias("_first"),
        F.max("last_doc").over(run).alias("_last"),
    )
    rows = compared.where("head is null").join(F.broadcast(borders), F.col("run_id") == F.col("_run"), "left")
    return rows.where("_run is null or _first <> _last").select(
        F.coalesce("_whole", "run_id").alias("run_id"), F.coalesce("_first", "first_doc").alias("first_doc"),
        "whole", "doc", "digest", "first", "last",
    )


def _window_rows(docs: DataFrame, least: int, run: int) -> DataFrame:
    """``(window1, window2, doc, digest, at)``: all windows in the ranges ``(first, last)`` of ``ranges``,
    by a digest of their words."""
    make = _tools(least, run)

    def task(batches):
        import numpy as np
        import pandas as pd

        cut, _, digests = make()
        names = ["window1", "window2", "doc", "digest", "at"]
        for batch in batches:
            out, held = [], 0
            columns = (batch["doc"].tolist(), batch["digest"].tolist(), batch["text"], batch["ranges"])
            for doc, digest, text, ranges in zip(*columns):
                _, line, places = cut(text)
                at = np.unique(np.concatenate([np.arange(r["first"], r["last"] + 1) for r in ranges]))
                n = len(at)
                windows = digests(line[places[i] : places[i + least] - 1] for i in at.tolist())
                out.append((windows[:, 0], windows[:, 1], np.full(n, doc), np.full(n, digest), at.astype(np.int32)))
                held += n
                if held > 200_000:
                    yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out)))))
                    out, held = [], 0
            if out:
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out)))))

    return docs.mapInPandas(task, "window1 bigint, window2 bigint, doc bigint, digest bigint, at int")


def _doc(key: str, text: str) -> Column:
    """The id, or for a null one a number from the text, beyond other ids."""
    own = F.lit(FIRST_NULL_ID) + F.pmod(F.xxhash64(text_of(text)), F.lit(FIRST_NULL_ID))
    return F.coalesce(F.col(key).cast("bigint"), own)


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        _doc(key, text).alias("doc"), F.xxhash64(text_of(text)).alias("digest"), text_of(text).alias("text")
    )


def repeated_ranges(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, run: int = RUN
) -> DataFrame:
    """``(doc, digest, start, stop, first_doc)``: overlapping ranges of words that at least two
    documents have; ``first_doc`` is the one in which they stay."""
    keyed = _keyed(docs, key, text)
    # Stored, since a sort by range reads its rows twice.
    suffixes = stored(_suffix_rows(keyed, least, run), "suffixes")
    matched = _matched(suffixes)
    mixed = (
        matched.groupBy("run_id").agg(F.min("whole").alias("a"), F.max("whole").alias("b"))
        .where("a <> b").select("run_id", F.lit(True).alias("mixed"))
    )
    # Stored, so that the joins have shuffles of their own, which the skew join can split.
    mixed = stored(mixed, "mixed")
    met = stored(matched.join(mixed, "run_id", "left").drop("run_id", "whole"), "met")
    whole = met.where("mixed is null").select(
        "doc", "digest", F.col("first").alias("start"), (F.col("last") + least).alias("stop"), "first_doc"
    )
    # One document may be there in several rows; its ranges are asked for once.
    asked = met.where("mixed").groupBy("doc", "digest").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    # Repeated rows are one document, so any one of them will do.
    windows = stored(_window_rows(keyed.join(asked, ["doc", "digest"]), least, run), "windows")
    shared = stored(
        windows.groupBy("window1", "window2").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
        .where("first_doc <> last_doc").select("window1", "window2", "first_doc"),
        "shared",
    )
    single = windows.join(shared, ["window1", "window2"]).select(
        "doc", "digest", F.col("at").alias("start"), (F.col("at") + least).alias("stop"), "first_doc"
    )
    return whole.unionByName(single)


def repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, run: int = RUN
) -> DataFrame:
    """``(doc, digest, kept, start_word, n_words, first_doc)``: the ranges of a document joined to
    spans, those that stay (``kept``) and those to be cut each for itself; ``first_doc`` is the
    smallest of the documents in which parts of the span stay."""
    rows = repeated_ranges(docs, key, text, least, run).withColumn("kept", F.col("doc") == F.col("first_doc"))
    line = Window.partitionBy("doc", "digest", "kept").orderBy("start", "stop")
    reach = F.max("stop").over(line.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("new", F.when(reach >= F.col("start"), 0).otherwise(1))
    rows = rows.withColumn("span", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        rows.groupBy("doc", "digest", "kept", "span")
        .agg(F.min("start").alias("start_word"), F.max("stop").alias("stop"), F.min("first_doc").alias("first_doc"))
        .select(
            "doc", "digest", "kept", F.col("start_word").cast("bigint").alias("start_word"),
            (F.col("stop") - F.col("start_word")).cast("bigint").alias("n_words"), "first_doc",
        )
    )


def _without(text: Column, spans: Column) -> Column:
    """The text without the words of the spans; the rest stays as it was written."""
    import pandas as pd

    def run(texts: pd.Series, spans: pd.Series) -> pd.Series:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+")

        def one(text, spans):
            if spans is None or not len(spans):
                return text
            places = [m.span() for m in word.finditer(text)]
            out, at = [], 0
            for first, n in sorted((int(s["start_word"]), int(s["n_words"])) for s in spans):
                out.append(text[at : places[first][0]])
                at = places[first + n - 1][1]
            return "".join([*out, text[at:]])

        return pd.Series([one(t, s) for t, s in zip(texts, spans)], dtype=object)

    # Marked so that a filter on the result does not run it a second time.
    return F.pandas_udf(run, "string").asNondeterministic()(text, spans)


def cut_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars",
    least: int = LEAST, run: int = RUN,
) -> DataFrame:
    """``docs`` without the passages that stay elsewhere. ``chars``, if there is such a column, is the
    new length of a text that was cut. Documents of which no word is left go."""
    columns = docs.columns
    cuts = (
        repeated_spans(docs, key, text, least, run).where("not kept").groupBy("doc", "digest")
        .agg(F.collect_list(F.struct("start_word", "n_words")).alias("spans"))
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        _doc(key, text).alias("doc"),
        F.xxhash64(text_of(text)).alias("digest"),
    ).join(cuts, ["doc", "digest"], "left")
    cut = F.col("spans").isNotNull()
    body = F.col(f"row.`{text}`")
    rows = rows.withColumn("_text", F.when(cut, _without(body.cast("string"), F.col("spans"))).otherwise(body))
    rows = rows.where(~cut | (F.translate(F.col("_text"), " \t\n\x0b\x0c\r", "") != ""))
    out = {text: F.col("_text")}
    if chars in columns:
        kind = dict(docs.dtypes)[chars]
        out[chars] = F.when(cut, F.length("_text").cast(kind)).otherwise(F.col(f"row.`{chars}`"))
    return rows.select(*[out.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])
