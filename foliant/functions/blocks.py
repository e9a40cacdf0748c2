"""Blocks of a markdown text as HTML: quotes and lists of any depth, headings, code, tables.

One fold reads the lines with a stack of open containers.  A line first says which of
them it still belongs to, then which it opens, and what is left of it goes to the
paragraph, code or heading inside.  Whether a list is loose is known at its end; its
paragraphs are written after that.

Lines that start at the margin after a blank one, without a mark of their own, end
all containers.  Texts are cut there, so a fold is as long as a list and not as a text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import inline
from .text import let, rewrite

_ITEM = r"\A( {0,3})([-*+]|\d{1,9}[.)])( +|\z)"
_QUOTE = r"\A {0,3}> ?"
_RULE = r"\A {0,3}(?:(?:- *){3,}|(?:\* *){3,}|(?:_ *){3,})\z"
_HEADING = r"\A {0,3}(#{1,6})(?: +|\z)(.*?)(?: +#+)? *\z"
_UNDERLINE = r"\A {0,3}(?:=+|-+) *\z"
_FENCE = r"\A {0,3}(`{3,}(?=[^`]*\z)|~{3,})"
_STARTS = rf"{_QUOTE}|{_RULE}|{_HEADING}|{_FENCE}"

# Lines that need the fold, as those with a bar do; all others are paragraphs between blank lines.
_BLOCKS = r"(?m)^(?: {0,3}(?:[-*+](?: |$)|\d{1,9}[.)](?: |$)|>|#{1,6}(?: |$)|`{3}|~{3}|=+ *$|-+ *$|_ *_ *_)| {4})"

# What lines of the patterns above have as their first sign behind spaces.
_ITEM_SIGNS, _QUOTE_SIGN, _RULE_SIGNS, _HEADING_SIGN, _FENCE_SIGNS = "-*+0123456789", ">", "-*_", "#", "`~"
_START_SIGNS = _QUOTE_SIGN + _RULE_SIGNS + _HEADING_SIGN + _FENCE_SIGNS
_UNDERLINE_SIGNS, _RULER_SIGNS = "=-", "|:-"

# A row of bars and dashes between a table's head and its body.
_RULER = r"\A *\|?[ :]*-[-: |]*\z"

_CONTAINER = "struct<kind:string,indent:int,id:int>"
_STATE = (
    f"struct<out:string,open:array<{_CONTAINER}>,leaf:string,text:string,blank:boolean,"
    "loose:array<int>,next:int>"
)
_FIELDS = ["out", "open", "leaf", "text", "blank", "loose", "next"]


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _state(state: Column, **changes) -> Column:
    return F.struct(*[_lit(changes[n]).alias(n) if n in changes else state[n].alias(n) for n in _FIELDS]).cast(_STATE)


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


# A fold copies its state at every line, and a long text is copied faster than many rows:
# parts are laid end to end between signs that no text has.
_NEXT, _FIELD = "\ue002", "\ue003"


def _part(kind, text, id_=-1) -> Column:
    return F.concat(F.lit(_NEXT), _lit(kind), F.lit(_FIELD), _lit(text), F.lit(_FIELD), _lit(id_).cast("string"))


def _parts_of(out: Column) -> Column:
    def part(fields: Column) -> Column:
        named = (F.get(fields, i).alias(n) for i, n in enumerate(("kind", "text")))
        return F.struct(*named, F.get(fields, 2).cast("int").alias("id"))

    return F.transform(F.slice(F.split(out, _NEXT), 2, F.length(out)), lambda p: let(F.split(p, _FIELD), part))


def _html(text) -> Column:
    return _part("html", text)


def _bullet(kind: Column) -> Column:
    return kind.isin("-", "*", "+")


def _is_item(container: Column) -> Column:
    return F.coalesce(container["kind"] != ">", F.lit(False))


def _tag(kind: Column) -> Column:
    return F.when(_bullet(kind), "ul").otherwise("ol")


def _indent(text: Column) -> Column:
    return F.length(text) - F.length(F.ltrim(text))


def _blank(text: Column) -> Column:
    return F.ltrim(text) == ""


def _fits(text: Column, pattern: str, signs: str) -> Column:
    """Whether a pattern fits that begins with one of the signs; other lines skip it."""
    return F.contains(F.lit(signs), F.substring(F.ltrim(text), 1, 1)) & text.rlike(pattern)


def _quoted(text: Column) -> Column:
    return F.ltrim(text).startswith(_QUOTE_SIGN) & (_indent(text) <= 3)


def _fenced(state: Column) -> Column:
    return F.substring(state["leaf"], 1, 1).isin("`", "~")


def _finished(state: Column) -> Column:
    """The open paragraph or code written out."""
    owner = F.get(state["open"], F.size(state["open"]) - 1)
    kind = F.when(state["leaf"] == "p", "p").otherwise("code")
    text = F.when(state["leaf"] == "code", F.regexp_replace(state["text"], r"\n+\z", "\n")).otherwise(state["text"])
    made = _part(kind, text, F.when(_is_item(owner), owner["id"]).otherwise(-1))
    return F.when(state["leaf"] == "", state).otherwise(_state(state, out=F.concat(state["out"], made), leaf="", text=""))


def _closed(containers: Column, sibling: Column) -> Column:
    """What ends containers, the innermost first; the outermost list goes on if a sibling follows."""
    last = F.size(containers) - 1

    def end(c: Column, i: Column) -> Column:
        ends = F.concat(F.lit("</li>\n</"), _tag(c["kind"]), F.lit(">"))
        return F.when(c["kind"] == ">", "\n</blockquote>").when((i == last) & sibling, "</li>").otherwise(ends)

    return F.array_join(F.transform(F.reverse(containers), lambda c, i: _html(end(c, i))), "")


def _opened(containers: Column, sibling: Column) -> Column:
    def start(c: Column, i: Column) -> Column:
        number = F.when(~_bullet(c["kind"]) & (F.substring(c["kind"], 2, 9) != "1"), F.concat(F.lit(' start="'), F.substring(c["kind"], 2, 9), F.lit('"')))
        list_ = F.concat(F.lit("\n<"), _tag(c["kind"]), F.coalesce(number, F.lit("")), F.lit(">\n<li>"))
        return F.when(c["kind"] == ">", "\n<blockquote>").when((i == 0) & sibling, "\n<li>").otherwise(list_)

    return F.array_join(F.transform(containers, lambda c, i: _html(start(c, i))), "")


def _family(kind: Column) -> Column:
    """What items of one list share: the bullet, or the sign behind the number."""
    return F.substring(kind, 1, 1)


def _matched(open_: Column, line: Column) -> Column:
    """How many containers the line goes on in, and what is left of it."""
    start = F.struct(line.alias("rest"), F.lit(0).alias("kept"), F.lit(True).alias("on"))

    def step(s: Column, c: Column) -> Column:
        def with_blank(b: Column) -> Column:
            on = F.when(c["kind"] == ">", _quoted(s["rest"])).otherwise(b | (_indent(s["rest"]) >= c["indent"]))
            rest = F.when(c["kind"] == ">", F.regexp_replace(s["rest"], _QUOTE, "")).when(b, F.lit("")).otherwise(
                F.substring(s["rest"], c["indent"] + 1, F.length(s["rest"]))
            )
            inside = F.struct(rest.alias("rest"), (s["kept"] + 1).cast("int").alias("kept"), F.lit(True).alias("on"))
            return F.when(on, inside).otherwise(F.struct(s["rest"].alias("rest"), s["kept"].alias("kept"), F.lit(False).alias("on")))

        return F.when(s["on"], let(_blank(s["rest"]), with_blank)).otherwise(s)

    return F.aggregate(open_, start, step)


def _fresh(rest: Column, in_text: Column, next_: Column) -> Column:
    """Containers that open at the start of what is left, and what is left behind them.

    Inside a paragraph only a quote, a bullet with text, or the number 1 opens one.
    """
    start = F.struct(rest.alias("rest"), _none(_CONTAINER).alias("new"), F.lit(True).alias("on"))
    marks = F.length(F.regexp_extract(rest, r"\A(?: *(?:>|[-*+](?= |\z)|\d{1,9}[.)](?= |\z)))+", 0))

    def step(s: Column, _: Column) -> Column:
        text = in_text & (F.size(s["new"]) == 0)
        item = _fits(s["rest"], _ITEM, _ITEM_SIGNS) & ~_fits(s["rest"], _RULE, _RULE_SIGNS) & (~text | s["rest"].rlike(r"\A {0,3}(?:[-*+]|1[.)]) +[^ ]"))

        def opened(kind, indent, cut: Column) -> Column:
            one = F.struct(_lit(kind).alias("kind"), _lit(indent).cast("int").alias("indent"), (next_ + F.size(s["new"])).cast("int").alias("id"))
            return F.struct(cut.alias("rest"), F.concat(s["new"], F.array(one)).alias("new"), F.lit(True).alias("on"))

        def with_mark(p: Column) -> Column:
            lead, mark, gap = p["lead"], p["mark"], p["gap"]
            bare = F.length(s["rest"]) == lead + F.length(mark) + gap
            number = F.concat(F.substring(mark, -1, 1), F.regexp_replace(F.regexp_replace(mark, r"[.)]", ""), r"\A0+(?=\d)", ""))
            kind = F.when(_bullet(mark), mark).otherwise(number)
            width = lead + F.length(mark) + F.when(bare | (gap > 4), 1).otherwise(gap)
            return let(width, lambda w: opened(kind, w, F.substring(s["rest"], w + 1, F.length(s["rest"]))))

        parts = F.struct(
            _indent(s["rest"]).alias("lead"), F.regexp_extract(s["rest"], _ITEM, 2).alias("mark"),
            F.length(F.regexp_extract(s["rest"], _ITEM, 3)).alias("gap"),
        )
        none = F.struct(s["rest"].alias("rest"), s["new"].alias("new"), F.lit(False).alias("on"))
        return (
            F.when(~s["on"], s)
            .when(_quoted(s["rest"]), opened(">", 0, F.regexp_replace(s["rest"], _QUOTE, "")))
            .when(item, let(parts, with_mark))
            .otherwise(none)
        )

    signed = F.contains(F.lit(_QUOTE_SIGN + _ITEM_SIGNS), F.substring(F.ltrim(rest), 1, 1))
    read = let(marks, lambda n: F.when(n > 0, F.aggregate(F.sequence(F.lit(1), n), start, step)).otherwise(start))
    return F.when(signed, read).otherwise(start)


def _leaf(state: Column, rest: Column) -> Column:
    """What is left of a line goes to the leaf; containers are as they should be."""
    blank = _blank(rest)
    text = state["text"]
    fence = F.regexp_extract(rest, _FENCE, 1)

    def after(done: Column) -> Column:
        heading = _part(F.concat(F.lit("h"), F.length(F.regexp_extract(rest, _HEADING, 1)).cast("string")), F.regexp_extract(rest, _HEADING, 2))
        return (
            F.when(blank, done)
            .when(_fits(rest, _RULE, _RULE_SIGNS), _state(done, out=F.concat(done["out"], _html("\n<hr>"))))
            .when(_fits(rest, _HEADING, _HEADING_SIGN), _state(done, out=F.concat(done["out"], heading)))
            .when(_fits(rest, _FENCE, _FENCE_SIGNS), _state(done, leaf=fence, text=""))
            .when(_indent(rest) >= 4, _state(done, leaf="code", text=F.concat(F.substring(rest, 5, F.length(rest)), F.lit("\n"))))
            .otherwise(_state(done, leaf="p", text=F.ltrim(rest)))
        )

    level = F.when(F.contains(rest, F.lit("=")), "h1").otherwise("h2")
    titled = _state(state, out=F.concat(state["out"], _part(level, text)), leaf="", text="")
    more = _state(state, text=F.concat(text, F.lit("\n"), F.ltrim(rest)))
    ruler = F.contains(rest, F.lit("|")) & _fits(rest, _RULER, _RULER_SIGNS)
    fenced = _fenced(state)
    ends = rest.rlike(r"\A {0,3}(?:`+|~+) *\z") & F.trim(rest).startswith(state["leaf"])
    whole = F.concat(text, F.substring(rest, F.when(state["leaf"] == "code", 5).otherwise(1), F.length(rest)), F.lit("\n"))
    return (
        F.when(fenced & ends, _finished(state))
        .when(fenced | ((state["leaf"] == "code") & (blank | (_indent(rest) >= 4))), _state(state, text=whole))
        .when((state["leaf"] == "p") & ~blank & _fits(rest, _UNDERLINE, _UNDERLINE_SIGNS), titled)
        .when((state["leaf"] == "p") & ~blank & (ruler | ~_fits(rest, _STARTS, _START_SIGNS)), more)
        .otherwise(let(_finished(state), after))
    )


def _line(state: Column, line: Column) -> Column:
    def with_match(m: Column) -> Column:
        whole = m["kept"] == F.size(state["open"])
        in_text = (state["leaf"] == "p") & whole & ~state["blank"]
        verbatim = whole & (_fenced(state) | ((state["leaf"] == "code") & (_indent(m["rest"]) >= 4)))
        none = F.struct(m["rest"].alias("rest"), _none(_CONTAINER).alias("new"), F.lit(True).alias("on"))
        deep = (_indent(m["rest"]) >= 4) & (state["leaf"] != "p")
        underlined = _fits(m["rest"], _UNDERLINE, _UNDERLINE_SIGNS) | _fits(m["rest"], _RULER, _RULER_SIGNS)
        fresh = F.when(verbatim | deep | (in_text & underlined), none).otherwise(_fresh(m["rest"], in_text, state["next"]))

        def with_fresh(f: Column) -> Column:
            gone = F.slice(state["open"], m["kept"] + 1, F.size(state["open"]))
            kept = F.slice(state["open"], 1, m["kept"])
            first, outer = F.get(f["new"], 0), F.get(state["open"], m["kept"])
            sibling = F.coalesce(_is_item(first) & _is_item(outer) & (_family(first["kind"]) == _family(outer["kind"])), F.lit(False))
            facts = F.struct((_blank(f["rest"]) & (F.size(f["new"]) == 0)).alias("blank"), sibling.alias("sibling"))
            return let(facts, lambda x: changed_by(f, gone, kept, outer, x["blank"], x["sibling"]))

        def changed_by(f: Column, gone: Column, kept: Column, outer: Column, blank: Column, sibling: Column) -> Column:
            lazy = ~whole & (F.size(f["new"]) == 0) & (state["leaf"] == "p") & ~state["blank"] & ~blank & ~_fits(f["rest"], _STARTS, _START_SIGNS)
            named = F.transform(
                f["new"], lambda c, i: F.when((i == 0) & sibling, F.struct(c["kind"].alias("kind"), c["indent"].alias("indent"), outer["id"].alias("id"))).otherwise(c)
            )
            inner = F.get(state["open"], m["kept"] - 1)
            # A blank line before this one parts two blocks of the item or two items of the list around it.
            parted = F.when(sibling, outer["id"]).when(_is_item(inner), inner["id"])
            loose = F.when(state["blank"] & ~blank & parted.isNotNull(), F.concat(state["loose"], F.array(parted))).otherwise(state["loose"])
            added = _state(state, text=F.concat(state["text"], F.lit("\n"), F.ltrim(f["rest"])))
            moved = ~whole | (F.size(f["new"]) > 0)

            def changed(done: Column) -> Column:
                def opened(new: Column) -> Column:
                    out = F.concat(done["out"], _closed(gone, sibling), _opened(new, sibling))
                    return _state(done, out=out, open=F.concat(kept, new), next=done["next"] + F.size(f["new"]))

                return let(named, opened)

            ready = F.when(moved, let(_finished(state), changed)).otherwise(state)
            done = let(ready, lambda r: _leaf(r, f["rest"]))
            held = (state["leaf"] != "") & (state["leaf"] != "p") & whole
            return F.when(lazy, added).otherwise(let(done, lambda d: _state(d, blank=blank & ~held, loose=loose)))

        # A blank line ends no container but quotes.
        return let(fresh, with_fresh)

    return let(_matched(state["open"], line), with_match)


def _next_line(state: Column, line: Column) -> Column:
    """What a line adds is put behind the parts at the end; a binding copies all that it holds."""
    own = _state(state, out="")
    return let(let(own, lambda s: _line(s, line)), lambda s: _state(s, out=F.concat(state["out"], s["out"])))


# What is written: text before, a leaf's own text, what becomes of it, text behind.
_WRITTEN = "struct<before:string,text:string,how:string,behind:string,depth:int>"


def _write(before, text="", how="", behind="", depth=0) -> Column:
    values = dict(before=before, text=text, how=how, behind=behind, depth=depth)
    return F.struct(*[_lit(v).alias(n) for n, v in values.items()]).cast(_WRITTEN)


def _cells(row: Column, tag: str) -> Column:
    bare = F.regexp_replace(F.regexp_replace(row, r"\A *\|? *|(?<!\\) *\| *\z| +\z", ""), r"(?<!\\) *\| *", "\ue001")
    cells = F.transform(F.split(bare, "\ue001"), lambda c: _write(f"<{tag}>", F.replace(c, F.lit("\\|"), F.lit("|")), "line", f"</{tag}>"))
    return F.concat(F.array(_write("\n<tr>")), cells, F.array(_write("</tr>")))


def _paragraph(part: Column, loose: Column) -> Column:
    """A paragraph, plain in a tight list; a table where its second line is a ruler."""

    def read(lines: Column) -> Column:
        body = F.flatten(F.transform(F.slice(lines, 3, F.size(lines)), lambda row: _cells(row, "td")))
        table = F.concat(F.array(_write("\n<table>")), _cells(F.get(lines, 0), "th"), body, F.array(_write("\n</table>")))
        tight = (part["id"] >= 0) & ~F.array_contains(loose, part["id"])
        shown = _write(F.when(tight, "\n").otherwise("\n<p>"), part["text"], "line", F.when(tight, "").otherwise("</p>"))
        ruled = F.coalesce(F.get(lines, 0).contains("|") & F.get(lines, 1).rlike(_RULER) & F.get(lines, 1).contains("|"), F.lit(False))
        return F.when(ruled, table).otherwise(F.array(shown))

    return let(F.split(part["text"], "\n"), read)


def _written(out: Column, loose: Column) -> Column:
    """Parts in the order and form they are written in; blocks at the margin stand a blank line apart."""

    def show(p: Column) -> Column:
        heading = _write(F.concat(F.lit("\n<"), p["kind"], F.lit(">")), p["text"], "line", F.concat(F.lit("</"), p["kind"], F.lit(">")))
        opens = F.size(F.regexp_extract_all(p["text"], F.lit("<(?:blockquote|ul|ol)"), F.lit(0)))
        ends = F.size(F.regexp_extract_all(p["text"], F.lit("</(?:blockquote|ul|ol)"), F.lit(0)))
        return (
            F.when(p["kind"] == "html", F.array(_write(p["text"], depth=opens - ends)))
            .when(p["kind"] == "p", _paragraph(p, loose))
            .when(p["kind"] == "code", F.array(_write("\n<pre><code>", p["text"], "code", "</code></pre>")))
            .otherwise(F.array(heading))
        )

    def apart(parts: Column) -> Column:
        depths = F.transform(parts, lambda p: F.struct(p["depth"].alias("depth"), (p["before"].startswith("\n") & ~p["before"].rlike(r"\A\n(?:</|<t[rd]>)")).alias("block")))

        def step(s: Column, d: Column) -> Column:
            return F.struct(
                F.concat(s["top"], F.when((s["depth"] == 0) & d["block"], "1").otherwise("0")).alias("top"), (s["depth"] + d["depth"]).cast("int").alias("depth")
            )

        start = F.struct(F.lit("").alias("top"), F.lit(0).alias("depth"))

        def glued(tops: Column) -> Column:
            def one(p: Column, i: Column) -> Column:
                before = F.concat(F.when(F.substring(tops, i + 1, 1) == "1", "\n").otherwise(""), p["before"])
                return _write(before, p["text"], p["how"], p["behind"])

            return F.transform(parts, one)

        return let(F.aggregate(depths, start, step)["top"], glued)

    return let(F.flatten(F.transform(_parts_of(out), show)), apart)


def _segment(text: Column) -> Column:
    start = F.struct(
        F.lit("").alias("out"), _none(_CONTAINER).alias("open"), F.lit("").alias("leaf"), F.lit("").alias("text"),
        F.lit(False).alias("blank"), _none("int").alias("loose"), F.lit(0).alias("next"),
    ).cast(_STATE)

    def ended(state: Column) -> Column:
        def close(done: Column) -> Column:
            return _written(F.concat(done["out"], _closed(done["open"], F.lit(False))), done["loose"])

        return let(_finished(state), close)

    return F.aggregate(F.split(text, "\n"), start, _next_line, ended)


def _plains(text: Column) -> Column:
    """Paragraphs between blank lines."""
    some = F.filter(F.split(text, r"\n(?: *\n)+"), lambda p: ~p.rlike(r"\A\s*\z"))
    return F.transform(some, lambda p: _write("\n\n<p>", p, "line", "</p>"))


def _folded(text: Column) -> Column:
    return F.contains(text, F.lit("|")) | text.rlike(_BLOCKS)


def _parts(text: Column, fence: Column) -> Column:
    code = F.array(_write("\n\n<pre><code>", F.regexp_replace(text, r"\A[^\n]*\n?", ""), "code", "</code></pre>"))
    cut = F.split(text, r"\n(?: *\n)+(?=[^\s>*+\-=#\d|`~_])")

    def blocks(s: Column) -> Column:
        # A paragraph before the first blank line stands in no container; the fold begins behind it.
        def behind(pair: Column) -> Column:
            first, rest = F.get(pair, 0), F.get(pair, 1)
            own = _folded(first) | first.rlike(r"(?m)^[ *]")
            return F.when(own | rest.isNull(), _segment(s)).otherwise(F.concat(_plains(first), _segment(rest)))

        return let(F.split(s, r"\n(?: *\n)+", 2), behind)

    shown = F.flatten(F.transform(cut, lambda s: F.when(_folded(s), blocks(s)).otherwise(_plains(s))))
    return F.when(fence, code).otherwise(shown)


def render(markdown: Column) -> Column:
    """HTML of an article body: blocks a blank line apart.

    Quotes, lists (loose or tight, of any depth), headings of both kinds, tables, fenced and
    indented code, rules; marks inside lines are those of ``inline``.  Code fences at the margin
    are taken out first.  Raw tags are dropped; text between them stays, that of scripts and
    styles goes.
    """
    tabs = F.replace(F.replace(markdown, F.lit("\r\n"), F.lit("\n")), F.lit("\t"), F.lit("    "))
    parts = F.flatten(F.transform(F.split(tabs, r"(?m)^(?:```|~~~)"), lambda text, i: _parts(text, i % 2 == 1)))

    def show(p: Column) -> Column:
        inner = F.when(p["how"] == "line", inline.render(F.btrim(p["text"], F.lit(" \t\n\x0b\f\r"))))
        inner = inner.when(p["how"] == "code", inline.escape(p["text"])).otherwise("")
        return F.concat(p["before"], inner, p["behind"])

    laid = F.array_join(F.transform(parts, show), "")
    return rewrite(
        F.ltrim(laid, F.lit("\n")),
        [(r"(<li>)\n(?!<(?:[uo]l|blockquote))", "$1", "<li>\n"), (r"(</pre>)\n+(?=<[^/])", "$1", "</pre>\n")],
    )
