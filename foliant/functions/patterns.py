"""Character classes for Java regular expressions.

Java's ``\\s`` and ``\\w`` are ASCII only.  The texts handled here come with two
notions of white space, so every function names the one it needs.  The classes
are written without brackets and go inside ``[...]``.
"""

# White space as ECMAScript's \s defines it: controls, separators and the byte
# order mark.  One category test is many times faster than a list of ranges.
WEB_SPACE = r"\s\p{Z}\ufeff"

# White space as Python's str.isspace defines it.
TEXT_SPACE = r"\s\u001c-\u001f\u0085\p{Z}"

# Letters, numbers and underscore in any script.
WORD = r"\p{L}\p{N}_"

# Letters that have an upper or lower case.
CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def on_line(space: str) -> str:
    """The given white space without the line feed, as a bracketed class."""
    return rf"[{space}&&[^\n]]"
