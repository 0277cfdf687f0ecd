"""Path rules as column expressions.

Everything here is made of built-in functions, so it stays in the JVM and can be pushed below joins
and into scans. Two rules exist: *logical* paths (always rooted at ``/``) and *physical* paths
(POSIX rules, may be relative).
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from treeledger.schema import DEFAULT_WORLD

# The characters Unicode calls white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

def text(value: Column | str) -> Column:
    """A Python string becomes a literal, a column stays as it is."""
    return value if isinstance(value, Column) else F.lit(value)


def filled(value: Column) -> Column:
    """NULL counts as the empty string."""
    return F.coalesce(value, F.lit(""))


def world_name(value: Column | str) -> Column:
    return F.coalesce(F.nullif(text(value), F.lit("")), F.lit(DEFAULT_WORLD))


def trim_space(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITE_SPACE))


def forward_slashes(value: Column) -> Column:
    return F.replace(value, F.lit("\\"), F.lit("/"))


def _odd_segments(path: Column) -> Column:
    """True where a path holds an empty, ``.`` or ``..`` segment. Substring tests decide for almost
    all paths; the pattern runs only where some segment starts with a dot."""
    dotted = path.startswith(".") | path.contains("/.")
    return (
        (path == "")
        | path.endswith("/")
        | path.contains("//")
        | (dotted & path.rlike(r"(?:\A|/)\.{1,2}(?:/|\z)"))
    )


def _is_normal_location(path: Column) -> Column:
    return (
        path.startswith("/")
        & ~path.contains("\\")
        & ~F.lit(WHITE_SPACE).contains(F.right(path, F.lit(1)))
        & ~_odd_segments(path)
    )


def clean(path: Column) -> Column:
    """Shortest path with the same meaning, judged from the text alone; empty becomes ``.``.

    Only paths that hold an empty, ``.`` or ``..`` segment pay for the segment fold.
    """
    rooted = path.startswith("/")
    segments = F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda kept, s: F.when(s != "..", F.array_append(kept, s))
        .when(F.get(kept, F.size(kept) - 1) != "..", F.slice(kept, 1, F.size(kept) - 1))
        .when(rooted, kept)
        .otherwise(F.array_append(kept, s)),
    )
    body = F.array_join(folded, "/")
    cleaned = (
        F.when(rooted, F.concat(F.lit("/"), body)).when(body == "", ".").otherwise(body)
    )
    return F.when(_odd_segments(path), cleaned).otherwise(path)


def normalize_location(path: Column) -> Column:
    """Logical form: trimmed, forward slashes, rooted, no empty or dot segments."""
    slashed = forward_slashes(trim_space(filled(path)))
    return F.when(_is_normal_location(path), path).otherwise(
        clean(F.regexp_replace(slashed, "^(?!/)", "/"))
    )


def normalize_parent(path: Column) -> Column:
    """As :func:`normalize_location`, but the empty parent of a root stays empty (or NULL)."""
    return (
        F.when(path.isNull(), None)
        .when(_is_normal_location(path), path)
        .when(trim_space(path) == "", "")
        .otherwise(normalize_location(path))
    )


def normalize_physical(path: Column) -> Column:
    """Clean first, then turn backslashes, then drop one closing slash."""
    return F.regexp_replace(forward_slashes(clean(path)), r"/\z", "")


def is_absolute(path: Column) -> Column:
    return path.startswith("/")


def drop_closing_slash(path: Column) -> Column:
    return F.regexp_replace(path, r"/\z", "")


def under_root(path: Column, root: Column | str, compat: bool = False) -> Column:
    """True for the root itself and all below it.

    With ``compat`` the root ``/`` admits nothing but itself.
    """
    root = text(root)
    stem = root if compat else drop_closing_slash(root)
    return (path == root) | path.startswith(F.concat(stem, F.lit("/")))


def relative_parent(parent: Column, root: Column | str, compat: bool = False) -> Column:
    """Logical path of a physical folder below ``root``; anything outside counts as ``/``.

    With ``compat`` a sibling that shares the root's spelling (``/a/b2`` for ``/a/b``) counts as
    inside.
    """
    stem = drop_closing_slash(forward_slashes(text(root)))
    path = forward_slashes(clean(forward_slashes(parent)))
    inside = path.startswith(stem if compat else F.concat(stem, F.lit("/")))
    rest = F.regexp_replace(path.substr(F.length(stem) + 1, F.length(path)), "^/", "")
    return F.when(inside, F.concat(F.lit("/"), rest)).otherwise("/")


def child_location(parent_path: Column, name: Column) -> Column:
    return F.concat(F.when(parent_path == "/", "").otherwise(parent_path), F.lit("/"), name)


def child_physical(parent: Column, name: Column) -> Column:
    blank = F.lit("")
    joined = F.concat_ws("/", F.nullif(parent, blank), F.nullif(name, blank))
    return forward_slashes(F.when(joined == "", "").otherwise(clean(joined)))


def parent_location(path: Column) -> Column:
    """Logical parent of a normalised logical path; NULL for the root."""
    head = F.regexp_replace(path, r"/[^/]*\z", "")
    return F.when(path != "/", F.when(head == "", "/").otherwise(head))


def last_segment(path: Column) -> Column:
    return F.when(path == "/", "/").otherwise(F.substring_index(path, "/", -1))


def prefixes(path: Column) -> Column:
    """All folders on the way to a normalised rooted path, the root and the path included."""
    slash = F.lit("/")
    below = F.transform(
        F.sequence(F.lit(1), depth_of(path)),
        lambda i: F.call_function("substring_index", path, slash, i + 1),
    )
    return F.when(path == "/", F.array(slash)).otherwise(F.concat(F.array(slash), below))


def depth_of(path: Column) -> Column:
    return F.regexp_count(path, F.lit("[^/]+"))


def node_key(path: Column) -> Column:
    """Id of a node that this library makes: a digest of its logical path, ``root`` for ``/``."""
    return F.when(path == "/", "root").otherwise(F.md5(path))


def rfc3339(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ssXXX")
