"""Marks inside a line of markdown: code, links, emphasis, breaks.

Code spans, escapes, tags, addresses and link targets are cut out first, so no mark
is looked for inside them.  What is left is a row of tokens, which one fold reads with
a stack of open marks: a closing mark takes the nearest one that can open it, and
what was opened in between becomes plain text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, rewrite

HTML_ESCAPES = [("&", "&amp;", "&"), ("<", "&lt;", "<"), (">", "&gt;", ">")]

# Parts that are taken out whole, the earliest first: escapes, code, addresses, hidden
# parts and tags, and the end of a link with its target, whose brackets may nest twice.
_ROUND = r"(?:[^\s()\\]|\\.)"
_TARGET = rf"(?:<[^<>\n]*>|(?:{_ROUND}|\((?:{_ROUND}|\({_ROUND}*+\))*+\))*+)"
_TITLE = r"""(?:\s++(?:"[^"]*+"|'[^']*+'|\([^()]*+\)))?+"""
_APART = [
    r"\\[!-/:-@\[-`{-~]",
    r"(?<!`)(`++)(?=[^`])(?:[^`]++|(?!(?<!`)\1(?!`))`)++\1(?!`)",
    r"<(?:https?://|mailto:)[^<>\s]++>",
    r"(?i:<(script|style)\b[\s\S]*?</\2\s*+>)|<!--[\s\S]*?-->|</?[a-zA-Z][^<>]*+>",
    rf"\]\(\s*+{_TARGET}{_TITLE}\s*+\)",
    r"(?<![\p{L}\p{N}_/\"'=(])https?://[^\s<>*_~\[\]`\"]*+(?:[*_~][^\s<>*_~\[\]`\"]++)*+",
]
# All other signs are passed over without a look at the parts.
APART = rf"(?=[\\`<\]h])(?:{'|'.join(_APART)})"

# Texts without any of these have no marks.
MARKS, MARKED = r"[\\`<\[\]*_~]", ["http://", "https://", "  \n"]

_TOKENS = r"\*+|_+|~+|!?\[|\]|[^*_~\[\]!]+|!"
_EDGE = "\ue000"

# Targets that are kept.
_SAFE = r"\A(?:https?://|mailto:|/|#)"


def escape(text: Column) -> Column:
    return rewrite(text, HTML_ESCAPES)


def _attribute(text: Column) -> Column:
    return F.replace(escape(F.regexp_replace(text, r"\\([!-/:-@\[-`{-~])", "$1")), F.lit('"'), F.lit("&quot;"))


def _tag(name: str | Column, inner: Column) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    return F.concat(F.lit("<"), name, F.lit(">"), inner, F.lit("</"), name, F.lit(">"))


def _link(target: Column, shown: Column) -> Column:
    return F.concat(F.lit('<a href="'), _attribute(target), F.lit('">'), shown, F.lit("</a>"))


def _code(part: Column) -> Column:
    inner = F.regexp_replace(F.regexp_replace(part, r"\A`+|`+\z", ""), r"\n", " ")
    return _tag("code", escape(F.regexp_replace(inner, r"\A (?=.*[^ ])(.*) \z", "$1")))


def _bare(part: Column) -> Column:
    """An address that stands in the text; points and closing brackets at its end stay outside."""
    behind = F.regexp_extract(part, r"[?!.,:;*_~'\"]*\z", 0)

    def laid(address: Column) -> Column:
        return F.concat(_link(address, escape(address)), escape(behind))

    return let(F.regexp_replace(part, r"[?!.,:;*_~'\"]*\z", ""), laid)


def _cut_out(part: Column) -> Column:
    """HTML of a part that was taken out; ends of links are left to the fold."""
    return (
        F.when(part.startswith("\\"), escape(F.substring(part, 2, 2)))
        .when(part.startswith("`"), _code(part))
        .when(part.rlike(r"\A<(?:https?://|mailto:)"), let(F.regexp_replace(part, r"\A<|>\z", ""), lambda a: _link(a, escape(a))))
        .when(part.startswith("http"), _bare(part))
        .otherwise(F.lit(""))
    )


def _token(mark: Column | str, html: Column, size=0, opens=False, closes=False) -> Column:
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x)

    return F.struct(
        lit(mark).alias("mark"), html.alias("html"), lit(size).cast("int").alias("size"),
        F.coalesce(lit(opens), F.lit(False)).alias("opens"), F.coalesce(lit(closes), F.lit(False)).alias("closes"),
    )


def _plain(text: Column) -> Column:
    """Escaped text with its line breaks."""
    breaks = r"(?: {2,}|\\)\n *"
    return rewrite(escape(text), [(breaks, "<br>\n", "  \n"), (breaks, "<br>\n", "\\\n"), (r"\n +", "\n", "\n ")])


def _run(token: Column, before: Column, behind: Column) -> Column:
    """A run of marks; what stands on its sides decides whether it can open or close."""

    def sides(s: Column) -> Column:
        free_b, free_a = s["before"].rlike(r"\A\s*\z"), s["behind"].rlike(r"\A\s*\z")
        sign_b, sign_a = s["before"].rlike(r"[\p{P}\p{S}\ue000]"), s["behind"].rlike(r"[\p{P}\p{S}\ue000]")
        left = ~free_a & (~sign_a | free_b | sign_b)
        right = ~free_b & (~sign_b | free_a | sign_a)
        inside = token.startswith("_")
        opens = left & (~inside | ~right | sign_b)
        closes = right & (~inside | ~left | sign_a)
        return _token(F.substring(token, 1, 1), token, F.length(token), opens, closes)

    near = F.struct(
        F.coalesce(F.substring(before, -1, 1), F.lit(" ")).alias("before"), F.coalesce(F.substring(behind, 1, 1), F.lit(" ")).alias("behind")
    )
    return let(near, sides)


def _tokens(text: Column) -> Column:
    """The text as tokens: plain HTML, runs of marks, openings and ends of links."""
    apart = F.struct(F.regexp_extract_all(text, F.lit(APART), F.lit(0)).alias("out"), F.split(text, APART).alias("between"))

    def laid(a: Column) -> Column:
        last = F.size(a["out"])

        def piece(between: Column, i: Column) -> Column:
            padded = F.concat(F.when(i > 0, _EDGE).otherwise(""), between, F.when(i < last, _EDGE).otherwise(""))

            def read(found: Column) -> Column:
                def one(token: Column, n: Column) -> Column:
                    run = _run(token, F.when(n > 0, F.get(found, n - 1)), F.get(found, n + 1))
                    bare = F.replace(token, F.lit(_EDGE), F.lit(""))
                    return (
                        F.when(token.rlike(r"\A(?:[*_]|~~?\z)"), run)
                        .when(token.rlike(r"\A(?:!?\[|\])\z"), _token(token, token, 1))
                        .otherwise(_token("", _plain(bare)))
                    )

                return F.transform(found, one)

            own = let(F.regexp_extract_all(padded, F.lit(_TOKENS), F.lit(0)), read)
            part = F.get(a["out"], i)
            ended = F.when(part.startswith("]"), _token("](", part, 1)).otherwise(_token("", _cut_out(part)))
            return F.when(i < last, F.concat(own, F.array(ended))).otherwise(own)

        return F.flatten(F.transform(a["between"], piece))

    return let(apart, laid)


def _joined(tokens: Column) -> Column:
    """The tokens with plain ones that follow each other as one, so a fold is as long as the marks."""

    def with_places(marked: Column) -> Column:
        def between(low: Column, high: Column) -> Column:
            return _token("", F.array_join(F.transform(F.slice(tokens, low + 2, high - low - 1), lambda t: t["html"]), ""))

        def one(at: Column, i: Column) -> Column:
            before = F.coalesce(F.when(i > 0, F.get(marked, i - 1)), F.lit(-1))
            own = F.array(F.get(tokens, at))
            return F.when(at - before > 1, F.concat(F.array(between(before, at)), own)).otherwise(own)

        last = F.coalesce(F.get(marked, F.size(marked) - 1), F.lit(-1))
        return F.concat(F.flatten(F.transform(marked, one)), F.array(between(last, F.size(tokens))))

    places = F.filter(F.transform(tokens, lambda t, i: F.when(t["mark"] != "", i)), lambda i: i.isNotNull())
    return let(places, with_places)


_FRAME = "struct<mark:string,size:int,of:int,both:boolean,html:string>"


def _frame(mark, size, of, both, html) -> Column:
    parts = dict(mark=mark, size=size, of=of, both=both, html=html)
    return F.struct(*[(x if isinstance(x, Column) else F.lit(x)).alias(n) for n, x in parts.items()]).cast(_FRAME)


def _flat(frames: Column) -> Column:
    """Frames as plain text, their marks written out."""
    return F.array_join(F.transform(frames, lambda f: F.concat(F.repeat(f["mark"], f["size"]), f["html"])), "")


def _add(stack: Column, html: Column) -> Column:
    """The stack with more HTML in its top frame."""
    n = F.size(stack)
    top = F.get(stack, n - 1)
    changed = _frame(top["mark"], top["size"], top["of"], top["both"], F.concat(top["html"], html))
    return F.concat(F.slice(stack, 1, n - 1), F.array(changed))


def _last(stack: Column, fits) -> Column:
    """Place, from 0, of the topmost frame that fits; -1 if none does."""
    places = F.transform(stack, lambda f, i: F.when(fits(f, i), i).otherwise(-1))
    return F.coalesce(F.array_max(places), F.lit(-1))


def _close_run(stack: Column, token: Column) -> Column:
    """A run closes what it can, mark by mark; the rest opens, or is text."""
    start = F.struct(stack.alias("stack"), token["size"].alias("left"))

    def once(state: Column, _: Column) -> Column:
        frames, left = state["stack"], state["left"]
        wall = _last(frames, lambda f, i: f["mark"].endswith("["))

        def fits(f: Column, i: Column) -> Column:
            thirds = (f["both"] | (token["opens"] & token["closes"])) & ((f["of"] + token["size"]) % 3 == 0)
            thirds = thirds & ~((f["of"] % 3 == 0) & (token["size"] % 3 == 0))
            waves = (f["mark"] != "~") | (f["size"] == left)
            return (f["mark"] == token["mark"]) & (i > wall) & (f["size"] > 0) & waves & ((f["mark"] == "~") | ~thirds)

        def closed(at: Column) -> Column:
            def made(opener: Column) -> Column:
                used = F.when((opener["mark"] == "~") | ((opener["size"] >= 2) & (left >= 2)), F.least(left, F.lit(2))).otherwise(1)
                name = F.when(opener["mark"] == "~", "del").when(used == 2, "strong").otherwise("em")
                inner = F.concat(opener["html"], _flat(F.slice(frames, at + 2, F.size(frames))))
                html = _tag(name, inner)
                below = F.slice(frames, 1, at)
                more = opener["size"] - used
                kept = F.concat(below, F.array(_frame(opener["mark"], more, opener["of"], opener["both"], html)))
                return F.struct(F.when(more > 0, kept).otherwise(_add(below, html)).alias("stack"), (left - used).cast("int").alias("left"))

            return F.when(at < 0, state).otherwise(let(F.get(frames, at), made))

        return F.when(left > 0, let(_last(frames, fits), closed)).otherwise(state)

    closed = F.when(token["closes"], F.aggregate(F.sequence(F.lit(1), F.least(token["size"], F.lit(64))), start, once)).otherwise(start)

    def rest(state: Column) -> Column:
        left, frames = state["left"], state["stack"]
        opened = F.concat(frames, F.array(_frame(token["mark"], left, token["size"], token["closes"], "")))
        return F.when(left == 0, frames).when(token["opens"], opened).otherwise(_add(frames, F.repeat(token["mark"], left)))

    return let(closed, rest)


def _close_bracket(stack: Column, token: Column) -> Column:
    """The end of a link or image, or of a bracket that is neither."""

    def ended(at: Column) -> Column:
        bracket, below, above = F.get(stack, at), F.slice(stack, 1, at), F.slice(stack, at + 2, F.size(stack))
        text = F.concat(bracket["html"], _flat(above))
        target = F.regexp_replace(F.regexp_extract(token["html"], rf"\A\]\(\s*({_TARGET})", 1), r"\A<|>\z", "")

        def linked(t: Column) -> Column:
            image = F.concat(F.lit('<img src="'), _attribute(t), F.lit('" alt="'), F.regexp_replace(F.replace(text, F.lit('"'), F.lit("&quot;")), "<[^>]*>", ""), F.lit('">'))
            safe_image = F.when(t.rlike(r"\A(?:https?://|/)"), image).otherwise(F.regexp_replace(text, "<[^>]*>", ""))
            unsafe = ~t.rlike(_SAFE) | text.contains("<a href")
            plain = F.concat(F.lit("["), text, escape(token["html"]))
            return F.when(bracket["mark"] == "![", safe_image).when(unsafe, plain).otherwise(_link(t, text))

        # Without a target the bracket is text, and marks opened inside stay open.
        opened = F.concat(_add(below, F.concat(bracket["mark"], bracket["html"])), above)
        literal = F.when(token["mark"] == "](", escape(token["html"])).otherwise(F.lit("]"))
        return (
            F.when(at < 1, _add(stack, literal))
            .when(token["mark"] == "](", _add(below, let(target, linked)))
            .otherwise(_add(opened, F.lit("]")))
        )

    return let(_last(stack, lambda f, i: f["mark"].endswith("[")), ended)


def _folded(tokens: Column) -> Column:
    start = F.array(_frame("", 0, 0, False, ""))
    closes = F.array_max(F.transform(tokens, lambda t, i: F.when(t["mark"].startswith("]"), i).otherwise(-1)))
    numbered = let(closes, lambda last: F.transform(tokens, lambda t, i: F.struct(t.alias("t"), (i < last).alias("ends"))))

    def step(stack: Column, token: Column) -> Column:
        t = token["t"]
        opened = F.concat(stack, F.array(_frame(t["mark"], 1, 1, False, "")))
        return (
            F.when(t["mark"] == "", _add(stack, t["html"]))
            .when(t["mark"].endswith("["), F.when(token["ends"], opened).otherwise(_add(stack, t["mark"])))
            .when(t["mark"].startswith("]"), _close_bracket(stack, t))
            .otherwise(_close_run(stack, t))
        )

    return F.aggregate(numbered, start, step, _flat)


def render(text: Column) -> Column:
    """HTML of the text of a paragraph or heading.

    Code, links and images with a web, mail or local target, bare addresses, strong,
    emphasised and deleted text and hard breaks are made; raw tags are dropped; other
    targets leave the text as it stands, and an image its description.
    """
    marked = text.rlike(MARKS)
    for part in MARKED:
        marked = marked | F.contains(text, F.lit(part))
    return F.when(marked, let(_tokens(text), lambda found: _folded(_joined(found)))).otherwise(_plain(text))
