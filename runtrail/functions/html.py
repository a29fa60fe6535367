"""Column functions on a log page, read as an HTML parser reads it.

A page is cut into pieces: comments, scripts and styles whole, tags with their quoted attributes,
declarations, text. A state machine is folded over the tags: it keeps the stack of open elements
and where the last ``<pre>`` begins and ends. An end tag closes everything up to the element it
names, so the end of a surrounding element ends the block too; an end tag without an open element
means nothing; a block that is never closed ends with the page. Only tags pass through the fold, and
texts are joined once at its end, so the work grows with the page.

Known differences from a full parser: CDATA sections are declarations; unknown references and those
longer than a name of the table stay as they are.
"""

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from runtrail import fixed_values as fixed

_STATE = "struct<stack:array<string>,open:int,start:int,stop:int>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _code_point(code: Column) -> Column:
    """The character of a code point; one that has none is the replacement character."""
    written = F.map_from_arrays(
        F.array(*[F.lit(b) for b in _WINDOWS]), F.array(*[F.lit(c) for c in _WINDOWS.values()])
    )
    fits = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.coalesce(F.try_element_at(written, code), F.when(fits, char), F.lit("�"))


#: What bytes 128 to 159 stand for where a page names them by number.
_WINDOWS = {b: bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)}
_NAMES = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}


def decode_references(text: Column) -> Column:
    """The text with its character references replaced, by number or by name."""

    def one(piece: Column) -> Column:
        body = F.regexp_replace(piece, "^&#?|;$", "")
        hexadecimal = F.conv(F.substring(body, 2, 12), 16, 10)
        number = F.when(F.rlike(body, F.lit("^[xX]")), hexadecimal).otherwise(body).try_cast("bigint")
        named = F.try_element_at(_map(_NAMES), body)
        return (
            F.when(F.rlike(piece, F.lit(fixed.NUMBER_REFERENCE)), _code_point(F.coalesce(number, F.lit(-1))))
            .when(piece.startswith("&"), F.coalesce(named, piece))
            .otherwise(piece)
        )

    pieces = F.regexp_extract_all(text, F.lit(fixed.REFERENCES), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, one), "")).otherwise(text)


def _tags(pieces: Column) -> Column:
    """Number, name and kind of the pieces that open or close an element."""

    def tag(piece: Column, at: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, fixed.TAG_NAME, 1))
        kind = F.when(piece.startswith("</"), "close").when(piece.endswith("/>"), "empty").otherwise("open")
        # A script or style is one piece with its content, and changes nothing.
        counts = (name != "") & ~name.isin(*fixed.VOID_ELEMENTS, *fixed.RAW_ELEMENTS)
        return F.when(counts, F.struct(at.alias("at"), name.alias("name"), kind.alias("kind")))

    return F.array_compact(F.transform(pieces, tag))


def _last_block(pieces: Column) -> Column:
    """First and last piece of the last ``<pre>`` (``start``, ``stop``); null without one."""

    def step(state: Column, tag: Column) -> Column:
        stack, kind, is_pre = state["stack"], tag["kind"], tag["name"] == "pre"
        depth = F.size(stack)
        back = F.array_position(F.reverse(stack), tag["name"])
        # How many elements stay open after this end tag.
        left = (depth - back).cast("int")
        closes = (kind == "close") & (back > 0)
        ends = closes & (state["open"] > left)
        begins = is_pre & (kind != "close")
        return F.struct(
            F.when(closes, F.slice(stack, F.lit(1), left))
            .when(kind == "open", F.concat(stack, F.array(tag["name"]))).otherwise(stack).alias("stack"),
            F.when(begins, F.when(kind == "open", depth + 1).otherwise(0)).when(ends, 0).otherwise(state["open"]).alias("open"),
            F.when(begins, tag["at"] + 1).otherwise(state["start"]).alias("start"),
            F.when(begins, F.when(kind == "empty", tag["at"])).when(ends, tag["at"] - 1).otherwise(state["stop"]).alias("stop"),
        ).cast(_STATE)

    start = F.expr(f"CAST(named_struct('stack', array(), 'open', 0, 'start', NULL, 'stop', NULL) AS {_STATE})")
    return F.aggregate(_tags(pieces), start, step)


def _text_of(pieces: Column, block: Column) -> Column:
    stop = F.coalesce(block["stop"], F.size(pieces) - 1)
    inside = F.slice(pieces, block["start"] + 1, stop - block["start"] + 1)
    texts = F.filter(inside, lambda p: ~F.rlike(p, F.lit(fixed.MARKUP)))
    return F.when(block["start"].isNotNull(), F.array_join(F.transform(texts, decode_references), ""))


def _pieces(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(fixed.PAGE_PIECES), F.lit(0))


def has_pre(html: Column) -> Column:
    """Whether a page has a ``<pre>`` block, without cutting up the usual page."""
    hidden = html.rlike(fixed.MAY_HIDE_MARKUP)
    return html.rlike(fixed.PRE_MARK) & F.when(hidden, html.rlike(fixed.PRE_AFTER_PIECES)).otherwise(F.lit(True))


def last_pre(html: Column) -> Column:
    """Text of the last ``<pre>`` block of a page; NULL where the page has none.

    Of nested blocks the one that opens last counts. Comments, scripts and styles are not read,
    and a block's inner tags are left out.
    """
    text = _let(_pieces(html), lambda pieces: _let(_last_block(pieces), lambda block: _text_of(pieces, block)))
    return F.when(html.rlike(fixed.PRE_MARK), text)
