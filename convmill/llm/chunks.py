"""Texts as chunks that subword encoders treat apart: cut before each space that follows a character other than white space.

Both the byte-level pattern (no match goes on from such a character into a space, and none looks
back) and a piece vocabulary whose pieces hold the space mark only at their beginning cut there, so
a text's ids are its chunks' ids in turn and each chunk needs encoding only once.
"""

from __future__ import annotations

import re

_RUN = re.compile(r"\s ")
_BORDER = re.compile(r"(?<=\S)(?= )")


def chunks(text: str) -> list[str]:
    """The chunks of ``text``, each without one leading space; the first one counts as if a space stood before the text.

    ``" ".join`` of them is the text.
    """
    if _RUN.search(text) or text[:1] == " ":
        first, *rest = _BORDER.split(" " + text)
        return [first[1:], *[c[1:] for c in rest]]
    return text.split(" ")
