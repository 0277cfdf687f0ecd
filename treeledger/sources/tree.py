"""Mounted trees: listing, ranged reads, and writes that count only once committed.

The mount must be visible at the same path on every executor. The functions that run inside tasks
are closures over the standard library, so executors need no copy of this package.
"""

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeledger.functions import paths as P
from treeledger.operators.nodes import classify_entries
from treeledger.plans.copying import balanced_pieces
from treeledger.sources.store import shared_dir, stored

# Entries a task lists before it hands the folders it has not opened yet to the next round.
FIRST_BUDGET = 2_000
BUDGET = 200_000
# Bytes that one batch between Python and the JVM may hold.
BATCH_BYTES = 32 * 1024 * 1024

# Folders of a scan round for a task.
FOLDERS_PER_TASK = 100

# ``raw`` holds a path that is not UTF-8, whose ``path`` is then only for reading; ``problem`` says what
# could not be listed.
_LISTING = "path string, is_dir boolean, length bigint, mtime timestamp, pending boolean, raw binary, problem string"


def _tasks(spark: SparkSession, items: int, per_task: int) -> int:
    """Tasks for so many items of work: as many as run at once, if there are so many items, and more
    where a task would have over ``per_task``."""
    return max(1, min(items, max(spark.sparkContext.defaultParallelism, -(-items // per_task))))


def _lister(budget: int):
    def walk(batches):
        import errno
        import os
        from datetime import datetime, timezone

        import pandas as pd

        columns = ["path", "is_dir", "length", "mtime", "pending", "raw", "problem"]

        def row(path, is_dir, length=None, when=None, pending=False, problem=None):
            try:
                path.encode()
            except UnicodeEncodeError:
                raw = os.fsencode(path)
                return raw.decode("utf-8", "replace"), is_dir, length, when, pending, raw, problem or "not_utf8"
            return path, is_dir, length, when, pending, None, problem

        def frame(rows):
            out = pd.DataFrame(rows, columns=columns)
            out["length"] = out["length"].astype("Int64")
            out["mtime"] = pd.to_datetime(out["mtime"], utc=True)
            return out

        seen, rows = 0, []
        for batch in batches:
            for start in batch["path"]:
                stack = [os.fsdecode(start)]
                while stack:
                    folder = stack.pop()
                    if seen > budget:
                        rows.append(row(folder, True, pending=True))
                        continue
                    try:
                        entries = os.scandir(folder)
                    except OSError as problem:
                        # The folder's own row stands; what it holds cannot be read.
                        rows.append(row(folder, True, problem=errno.errorcode.get(problem.errno, "EIO")))
                        continue
                    with entries:
                        for entry in entries:
                            try:
                                info = entry.stat(follow_symlinks=False)
                                is_dir = entry.is_dir(follow_symlinks=False)
                            except OSError as problem:
                                rows.append(row(entry.path, None, problem=errno.errorcode.get(problem.errno, "EIO")))
                                continue
                            seen += 1
                            when = datetime.fromtimestamp(info.st_mtime, timezone.utc)
                            rows.append(row(entry.path, is_dir, info.st_size, when))
                            if is_dir and seen > budget:
                                rows.append(row(entry.path, True, pending=True))
                            elif is_dir:
                                stack.append(entry.path)
                            if len(rows) >= 10_000:
                                yield frame(rows)
                                rows = []
        if rows:
            yield frame(rows)

    return walk


def _list_all(spark: SparkSession, root: str, first_budget: int, budget: int) -> DataFrame:
    """Rows of ``_LISTING`` for all levels below ``root``.

    Tasks walk folders until their budget is used up; folders left unopened are spread over all
    tasks of the next round. So one deep or wide subtree does not stay with one task. Every round is
    a table in the shared folder, and a lost executor costs no more than its tasks.
    """
    if not os.path.isdir(root):
        raise NotADirectoryError(root)
    out = shared_dir(spark, "scan")
    frontier = spark.createDataFrame([(root.encode(),)], "path binary").coalesce(1)
    round_no = 0
    while True:
        target = f"{out}/round={round_no}"
        walk = _lister(budget if round_no else first_budget)
        frontier.select("path").mapInPandas(walk, _LISTING).write.parquet(target)
        unopened = spark.read.schema(_LISTING).parquet(target).where("pending").select(
            F.coalesce("raw", F.encode("path", "UTF-8")).alias("path")
        )
        if unopened.isEmpty():
            break
        # An explicit number, which adaptive execution leaves alone: these rows are small, the work
        # behind them is not.
        frontier = unopened.repartition(_tasks(spark, unopened.count(), FOLDERS_PER_TASK), "path")
        round_no += 1
    return spark.read.schema(_LISTING + ", round int").parquet(out).where("not pending")


def list_entries(
    spark: SparkSession, root: str, first_budget: int = FIRST_BUDGET, budget: int = BUDGET
) -> DataFrame:
    """Raw entries ``(path, is_dir, length, mtime)`` of all levels below ``root``, without those that
    :func:`scan_errors` has to tell of."""
    entries = _list_all(spark, root, first_budget, budget).where("problem is null")
    return entries.select("path", "is_dir", "length", "mtime")


def _errors(entries: DataFrame) -> DataFrame:
    return entries.where("problem is not null").select("path", "raw", "problem").distinct()


def scan_tree_with_errors(
    spark: SparkSession, root: str, first_budget: int = FIRST_BUDGET, budget: int = BUDGET
) -> tuple[DataFrame, DataFrame]:
    """``(nodes, errors)`` of one scan. ``errors(path, raw, problem)`` names what is missing in the nodes:
    folders that cannot be opened and entries without a state, by the name of the error, and names that
    are not UTF-8 (``not_utf8``), whose bytes are in ``raw``."""
    root = _absolute(root)
    entries = _list_all(spark, root, first_budget, budget)
    good = entries.where("problem is null").select("path", "is_dir", "length", "mtime")
    return classify_entries(good, root), _errors(entries)


def scan_tree(spark: SparkSession, root: str, strict: bool = False, **budgets: int) -> DataFrame:
    """Node rows of a mounted tree: hidden and empty files are kept, links are files, entries that
    cannot be read are left out, or an error if ``strict``. The root itself is no row."""
    nodes, errors = scan_tree_with_errors(spark, root, **budgets)
    if strict and (some := errors.limit(5).collect()):
        raise OSError("; ".join(f"{r['path']}: {r['problem']}" for r in some))
    return nodes


def _absolute(root: str) -> str:
    if not root.startswith("/"):
        raise ValueError("the root must be an absolute path")
    return os.path.normpath(root)


def read_chunks(files: DataFrame, buffer: int = 0) -> DataFrame:
    """Bytes of mounted files ``(node_id, size, ..)`` in pieces ``(chunk_no, start_byte, content,
    status)``.

    Pieces, not files, are spread over tasks, so a file of any size is read by many and none has to
    fit a row. A file that cannot be opened is ``not_found``.
    """
    plan = stored(balanced_pieces(files, buffer), "pieces")
    tasks = (plan.agg(F.max("task")).first()[0] or 0) + 1
    # A partition is a share of the work, whatever the number of files in it.
    plan = plan.repartitionById(tasks, F.col("task")).drop("task")
    limit = BATCH_BYTES

    def read(batches):
        source, last = None, None
        try:
            for batch in batches:
                first, held, contents, states = 0, 0, [], []
                spans = zip(batch["node_id"], batch["start_byte"], batch["length"])
                for at, (path, start_byte, length) in enumerate(spans, 1):
                    content, state = None, "ok"
                    try:
                        # Pieces of a file mostly follow each other: it stays open for the next one.
                        if source is None or path != last:
                            if source is not None:
                                source.close()
                            source = None
                            source, last = open(path, "rb"), path
                        source.seek(int(start_byte))
                        content = source.read(int(length))
                        if len(content) < length:
                            state = "short_read"
                    except OSError:
                        state = "not_found"
                    contents.append(content)
                    states.append(state)
                    held += len(content or b"")
                    if held >= limit or at == len(batch):
                        yield batch.iloc[first:at].assign(content=contents, status=states)
                        first, held, contents, states = at, 0, [], []
        finally:
            if source is not None:
                source.close()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema.fields)
    return plan.mapInPandas(read, f"{fields}, content binary, status string")


def write_tree(rows: DataFrame, root: str, create: bool = True) -> DataFrame:
    """Write files ``(location_path, content[, start_byte])`` below ``root`` and return one status
    row per file: ``(location_path, size, status)``.

    A file may come in several pieces, in any order and from any task. First every piece is written
    to a staged file, next the list of pieces is stored as a table, and only then a second job moves
    complete files to their place. Files whose pieces overlap or leave gaps, or do not reach the
    ``planned_size`` that the rows may name, are ``incomplete`` and stay out; where rows name a
    ``problem``, that is their status. Without ``create`` only files that exist are replaced, others are
    ``not_found``. Staging is beside ``root``, if that is on the same mount. The move can be repeated: after a failure, ``commit_tree`` finishes from the table.
    """
    if not root.startswith("/"):
        raise ValueError("the root must be an absolute path")
    spark = rows.sparkSession
    root = os.path.normpath(root)
    os.makedirs(root, exist_ok=True)
    beside = os.stat(os.path.dirname(root)).st_dev == os.stat(root).st_dev and os.access(
        os.path.dirname(root), os.W_OK
    )
    staging = f"{root}{'' if beside else '/'}.staging-{uuid.uuid4().hex}"
    os.makedirs(staging)
    start = F.col("start_byte") if "start_byte" in rows.columns else F.lit(0)
    path = P.normalize_location(F.col("location_path"))
    pieces = rows.select(
        path.alias("location_path"),
        F.concat(
            F.lit(staging + "/"), F.substring(F.md5(path), 1, 2), F.lit("/"), F.md5(path)
        ).alias("staged"),
        start.cast("bigint").alias("start_byte"),
        "content",
        *[
            (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in (("planned_size", "bigint"), ("problem", "string"))
        ],
    )

    def stage(batches):
        import os

        def opened(staged):
            try:
                return os.open(staged, os.O_WRONLY | os.O_CREAT, 0o644)
            except FileNotFoundError:
                os.makedirs(os.path.dirname(staged), exist_ok=True)
                return os.open(staged, os.O_WRONLY | os.O_CREAT, 0o644)

        for batch in batches:
            lengths, inodes = [], []
            handle, last = None, None
            try:
                for staged, start_byte, content in zip(
                    batch["staged"], batch["start_byte"], batch["content"]
                ):
                    # Pieces of a file mostly follow each other: it stays open for the next one.
                    if handle is None or staged != last:
                        if handle is not None:
                            done, handle = handle, None
                            os.close(done)
                        handle, last = opened(staged), staged
                        inode = os.fstat(handle).st_ino
                    inodes.append(inode)
                    view, at = memoryview(content or b""), int(start_byte)
                    lengths.append(len(view))
                    while view:
                        done = os.pwrite(handle, view, at)
                        view, at = view[done:], at + done
            finally:
                if handle is not None:
                    os.close(handle)
            kept = ["location_path", "staged", "start_byte", "planned_size", "problem"]
            yield batch[kept].astype({"planned_size": "Int64"}).assign(length=lengths, inode=inodes)

    manifest = shared_dir(spark, "manifest")
    pieces.mapInPandas(
        stage,
        "location_path string, staged string, start_byte bigint, planned_size bigint, problem string, "
        "length bigint, inode bigint",
    ).write.parquet(manifest)
    status = commit_tree(spark, manifest, root, create)
    for part in os.listdir(staging):
        # Folders that still hold refused files stay for inspection.
        try:
            os.rmdir(f"{staging}/{part}")
        except OSError:
            pass
    try:
        os.rmdir(staging)
    except OSError:
        pass
    return status


def _placer():
    def place(staged, final):
        """Move a staged file to its place.

        A rename between two folders waits for all others on the filesystem, a link only for those into its
        folder. So a new file is linked to its place and then leaves the staging; one that takes the place of
        another is renamed, in one step.
        """
        import os

        try:
            os.link(staged, final)
        except FileExistsError:
            # The same file was linked by a run that did not come to the next step.
            if not (os.path.isfile(final) and os.path.samefile(staged, final)):
                os.replace(staged, final)
                return
        except (FileNotFoundError, NotADirectoryError):
            raise
        except OSError:  # a mount without links
            os.replace(staged, final)
            return
        try:
            os.unlink(staged)
        except FileNotFoundError:  # another attempt of this task took it out
            pass

    return place


def commit_tree(spark: SparkSession, manifest: str, root: str, create: bool = True) -> DataFrame:
    """Move the staged files of a manifest to their place below ``root``; safe to run again: a file that
    an earlier run moved is known by its inode (by its size, where a manifest names no inode). One that is
    neither staged nor moved is ``lost``, whatever stands in its place."""
    pieces = spark.read.parquet(manifest)
    for name, kind in (("planned_size", "bigint"), ("problem", "string"), ("inode", "bigint")):
        if name not in pieces.columns:
            pieces = pieces.withColumn(name, F.lit(None).cast(kind))
    file = ["location_path", "staged"]
    # Count starts up and ends down at every position. Pieces tile the file exactly when all
    # positions cancel but one start at 0 and one end: pieces only lead forward, so what is left is
    # a single chain from 0 to the end. Counts combine map-side, however many pieces a file has.
    ends = F.array(
        F.struct(F.col("start_byte").alias("at"), F.lit(1).alias("step")),
        F.struct((F.col("start_byte") + F.col("length")).alias("at"), F.lit(-1).alias("step")),
    )
    loose = (
        pieces.where("length > 0")
        .select(*file, F.inline(ends))
        .groupBy(*file, "at")
        .agg(F.sum("step").alias("step"))
        .where("step <> 0")
        .groupBy(*file)
        .agg(
            F.count(F.lit(1)).alias("_ends"),
            F.count_if(F.expr("at = 0 and step = 1")).alias("_first"),
            F.count_if(F.expr("step = -1")).alias("_last"),
        )
    )
    tiled = (F.col("size") == 0) | (
        (F.col("_ends") == 2) & (F.col("_first") == 1) & (F.col("_last") == 1)
    )
    planned = F.coalesce(F.col("planned_size") == F.col("size"), F.lit(True))
    whole = F.coalesce(tiled, F.lit(False)) & planned & F.col("problem").isNull()
    files = (
        pieces.groupBy(*file)
        .agg(
            F.sum("length").alias("size"), F.max("planned_size").alias("planned_size"),
            F.min("problem").alias("problem"),
            # One staged file, whoever wrote into it; its number stays with it when it is moved.
            F.when(F.min("inode") == F.max("inode"), F.max("inode")).cast("string").alias("inode"),
        )
        .join(loose, file, "left")
        .select(*file, "size", "inode", whole.alias("whole"), F.coalesce("problem", F.lit("incomplete")).alias("refusal"))
    )

    place = _placer()

    def move(batches):
        import os

        for batch in batches:
            outcome = []
            for location, staged, size, inode, whole, refusal in zip(
                batch["location_path"], batch["staged"], batch["size"], batch["inode"], batch["whole"], batch["refusal"]
            ):
                final = root + location
                if not whole:
                    outcome.append(refusal)
                    continue
                try:
                    if os.path.isfile(final) and not os.path.exists(staged):
                        found = os.stat(final)
                        moved = str(found.st_ino) == inode if inode else found.st_size == size
                        outcome.append("written" if moved else "lost")  # by an earlier run, or not at all
                        continue
                    if not create and not os.path.isfile(final):
                        outcome.append("not_found")
                        continue
                    try:
                        place(staged, final)
                    except (FileNotFoundError, NotADirectoryError):
                        os.makedirs(os.path.dirname(final), exist_ok=True)
                        place(staged, final)
                    outcome.append("written")
                except FileNotFoundError:
                    outcome.append("lost")
                except OSError as problem:
                    outcome.append(f"failed: {problem.strerror}")
            yield batch[["location_path", "size"]].assign(status=outcome)

    done = f"{manifest}-status-{uuid.uuid4().hex}"
    files.mapInPandas(move, "location_path string, size bigint, status string").write.parquet(done)
    return spark.read.parquet(done)
