"""URL parts and reference resolution as native column expressions.

They follow the WHATWG-flavoured splitting of Python's ``urllib.parse``: the host
is lower-cased and free of user info, port and brackets, and dot segments fold
as in RFC 3986. Everything stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def _col(url: Column | str) -> Column:
    return F.col(url) if isinstance(url, str) else url


def _part(url: Column, index: int) -> Column:
    return F.regexp_extract(url, _PARTS, index)


def clean(url: Column | str) -> Column:
    """Drop leading control characters and spaces, and tabs and newlines anywhere."""
    return F.regexp_replace(F.regexp_replace(_col(url), r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def scheme(url: Column | str) -> Column:
    """Lower-cased scheme, '' if there is none."""
    return F.lower(F.regexp_extract(clean(url), _SCHEME, 1))


def hostname(url: Column | str) -> Column:
    """Lower-cased host, null if there is none."""
    # One pass picks the host behind scheme and user info, brackets included.
    host = F.regexp_extract(
        F.translate(_col(url), "\t\r\n", ""),
        r"(?s)^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^:/?#]*)",
        1,
    )
    return F.nullif(F.lower(F.translate(host, "[]", "")), F.lit(""))


def drop_fragment(url: Column | str) -> Column:
    return F.regexp_replace(_col(url), r"(?s)#.*$", "")


def is_web_url(url: Column | str) -> Column:
    """http or https with a host."""
    return scheme(url).isin("http", "https") & hostname(url).isNotNull()


def _fold_dots(segments: Column) -> Column:
    """Resolve '.' and '..' over an array of path segments."""
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda kept, seg: F.when(seg == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(seg == ".", kept)
        .otherwise(F.concat(kept, F.array(seg))),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    return F.when(ends_in_dots, F.concat(folded, F.array(F.lit("")))).otherwise(folded)


def _merge_paths(base_path: Column, path: Column) -> Column:
    """Path of a relative reference below the base's folder, or of a rooted one."""
    base_dir = F.regexp_replace(base_path, r"[^/]+$", "")

    def below(segments: Column) -> Column:
        inner = F.filter(F.slice(segments, 2, F.greatest(F.size(segments) - 2, F.lit(0))), lambda seg: seg != "")
        return F.when(F.size(segments) == 1, segments).otherwise(
            F.concat(F.slice(segments, 1, 1), inner, F.slice(segments, -1, 1))
        )

    segments = F.when(path.startswith("/"), F.split(path, "/", -1)).otherwise(
        let(F.split(F.concat(base_dir, F.lit("/"), path), "/", -1), below)
    )
    joined = F.array_join(let(segments, _fold_dots), "/")
    return let(joined, lambda p: F.when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p)))


def _marked(part: Column) -> Column:
    """A query or fragment with its mark; a bare '?' or '#' vanishes."""
    return F.when(F.length(part) > 1, part).otherwise(F.lit(""))


def _parts(url: Column) -> Column:
    return let(clean(url), lambda text: F.struct(
        F.lower(_part(text, 1)).alias("scheme"),
        _part(text, 2).alias("net"),
        _part(text, 3).alias("path"),
        _marked(_part(text, 4)).alias("query"),
        _marked(_part(text, 5)).alias("fragment"),
        text.alias("text"),
    ))


def absolutise(base: Column | str, reference: Column | str) -> Column:
    """Resolve ``reference`` against the http(s) URL ``base``."""
    given = _col(reference)

    def resolve(pair: Column) -> Column:
        b, r = pair["b"], pair["r"]
        origin = F.concat(b["scheme"], F.lit(":"), b["net"])
        tail = F.concat(r["query"], r["fragment"])
        return (
            F.when(F.length(r["text"]) == 0, b["text"])
            .when((r["scheme"] != "") & (r["scheme"] != b["scheme"]), given)
            .when(F.length(r["net"]) > 2, F.concat(b["scheme"], F.lit(":"), r["net"], r["path"], tail))
            .when(
                r["path"] == "",
                F.concat(origin, b["path"], F.when(r["query"] != "", r["query"]).otherwise(b["query"]), r["fragment"]),
            )
            .otherwise(F.concat(origin, _merge_paths(b["path"], r["path"]), tail))
        )

    return let(F.struct(_parts(_col(base)).alias("b"), _parts(given).alias("r")), resolve)


def robots_url(page_url: Column | str) -> Column:
    """Where the robots document of a page's origin lives."""
    return absolutise(page_url, F.lit("/robots.txt"))


def percent_decode(text: Column) -> Column:
    """Decode %XX escapes only; a '+' and a stray '%' stay as they are."""
    safe = F.regexp_replace(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B")
    return F.url_decode(safe)


def percent_encode(text: Column) -> Column:
    """Escape all but letters, digits and '_.-~/'."""
    out = F.url_encode(text)
    for code, char in ((r"\+", "%20"), ("%2F", "/"), ("%7E", "~"), (r"\*", "%2A")):
        out = F.regexp_replace(out, code, char)
    return out


def robots_path(url: Column | str) -> Column:
    """The normalised path, query and fragment that robots rules are matched on."""
    def tail(text: Column) -> Column:
        return F.concat(_part(text, 3), _marked(_part(text, 4)), _marked(_part(text, 5)))

    path = let(percent_decode(_col(url)), tail)
    return let(path, lambda p: F.when(p == "", F.lit("/")).otherwise(percent_encode(p)))
