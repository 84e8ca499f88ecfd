"""Operator 9: SVG, MathML, dialogs, and hidden elements that end with their parent."""

import pytest

from cropflow.llm import html


@pytest.mark.parametrize("page, text", [
    ("<p>a <svg width=1 /> b<p>c", "a b\n\nc"),
    ("a <math/> b", "a b"),
    ("<div hidden><svg/>x</div>rest", "rest"),
    ("a <svg><defs><path/><text>no</text></defs><g><path d=1 /><text x=1>one</text><text>two <tspan>three</tspan></text></g></svg> b", "a one two three b"),
    ("<svg><title>no</title>\n<style>.a{}</style><foreignObject><div>in<br>side</div></foreignObject></svg>after", "in\nside\nafter"),
    ("<svg><text display=none>no</text><path><p>rest", "rest"),
    ("<svg><defs><path><p>rest", "rest"),
    ("so <math><semantics><mrow><mi>x</mi>\n<mo>=</mo><mn>1</mn></mrow><annotation>no</annotation></semantics></math>.", "so x = 1 ."),
    ("<dialog>no</dialog><dialog open>yes</dialog>rest", "yes\nrest"),
    ("<section><div hidden>x</section><p>rest", "rest"),
    ("<div><span hidden>x</div> rest", "rest"),
    ("<div>a <canvas>x</div> rest", "a\nrest"),
    ("<b>a <i hidden>x</b> rest", "a rest"),
    # these stay hidden: the end tag is ignored inside them, or nothing open has its name
    ("<div>a<template>x</div>y</template>b</div>c", "ab\nc"),
    ("<span>a<div hidden>x</span>y</div>b</span>", "ab"),
    ("a<div hidden>x</section>y</div>b", "ab"),
    ("<div>a<table hidden><tr><td>x</div>y</table>b</div>", "ab"),
])
def test_foreign_and_unclosed(page, text):
    assert html.visible_text(page) == text
