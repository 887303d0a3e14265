"""Drawings and embedded elements in pages."""

import pytest

from vigil.llm.html_blocks import blocks


@pytest.mark.parametrize("page,want", [
    ("<article><svg class='i'/><p>a</p><canvas/><p>b</p><math/>c</article>", ["a", "b", "c"]),
    ("<article><p>a <svg><title>t</title><text>no</text></svg>b</p></article>", ["a b"]),
    ("<article><div>a<svg><path d='M'/></div><p>b</p></article><svg/><p>c</p>", ["a", "b", "c"]),
    ("<article><svg><path><p>b</p></article><p>c</p>", ["b", "c"]),
    ("<p>a</p><svg><foreignObject><div><p>no</p></div></foreignObject><svg><text>no</text></svg>no</svg><p>b</p>", ["a", "b"]),
    ("<p>a</p><section><svg><foreignObject><div>no</section><p>b</p>", ["a", "b"]),
    ("<article><p>x <math><mi>y</mi></math></p><noscript><p>n</p></noscript><object><p>o</p></object><canvas>k</canvas></article>",
     ["x y", "n", "o", "k"]),
])
def test_embedded_elements(page, want):
    assert [b[0] for b in blocks(page)] == want
