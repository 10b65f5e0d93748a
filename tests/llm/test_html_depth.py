"""The tree of op5 at any depth, and rows that nobody wrote."""

import time

import pytest

from textloom.llm import html_text


@pytest.mark.parametrize("made", [lambda n: "<div>" * n, lambda n: "<b>" * n + "</p>" * n, lambda n: "<ul><li>" * n, lambda n: "<table><td>" * n, lambda n: "<svg>" * n + "<g>" * n])
def test_time_is_linear_in_depth(made):
    took = []
    for n in (4_000, 32_000):
        began = time.perf_counter()
        html_text.parse(made(n))
        took.append(time.perf_counter() - began)
    assert took[1] < 40 * max(took[0], 0.02)


@pytest.mark.parametrize("html, text", [("<table><td>a<td>b</table>", "a | b"), ("<table><td>a<td>b<tr><td>cc<td>d</table>", "a  | b\ncc | d"), ("<table><tbody><th>a<td>b</tbody></table>", "a | b"), ("<td>a<td>b", html_text.render("<td>a<td>b"))])
def test_cells_begin_a_row(html, text):
    assert html_text.render(html) == text
