from __future__ import annotations

import pytest

from blotter.llm import quality_rules
from tests.llm import brute
from tests.llm.conftest import ODD_ROWS, prose


def report(docs):
    return quality_rules.quality_report(docs).collect()


def test_base_counts(documents):
    rows = [
        *ODD_ROWS,
        (30, "a b c a b c a b c x"),
        (31, "to be to be to be"),
        (32, "same line\nsame line\n \n \nsame line \n#*$%&|<>#"),
        (33, "\x1c not\x85a space  "),
        (34, prose(3000, 4, 30)),
        (35, "x" * 200_000),
    ]
    rows = [r if len(r) == 4 else (*r, "en", "s") for r in rows]
    wanted = sorted(((r[0], *brute.quality_counts(r[1])) for r in rows), key=repr)
    got = report(documents(*rows))
    measured = [
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got
    ]
    assert sorted(measured, key=repr) == wanted
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_empty_table(documents):
    assert report(documents("a").limit(0)) == []


def test_thresholds_follow_the_group(documents):
    """What is ordinary in one source is far out in another."""
    rows = []
    for n in range(240):
        plain, marked = prose(80, n), prose(80, 1000 + n).replace(" w", " |w")
        rows += [(n, plain, "en", "plain"), (1000 + n, marked, "en", "tables")]
    rows += [(5000, prose(80, 5).replace(" w", " |w"), "en", "plain")]
    kept = {r.doc_id: r.kept for r in report(documents(*rows))}
    assert not kept.pop(5000) and all(kept.values())


def test_a_small_group_borrows_from_its_language(documents):
    rows = [(n, prose(80, n), "en", "big") for n in range(240)]
    rows += [(1000, prose(80, 77), "en", "tiny"), (1001, prose(80, 78).replace(" w", " #w#"), "en", "tiny")]
    rows += [(1002, prose(80, 79), None, None)]
    kept = {r.doc_id: r.kept for r in report(documents(*rows))}
    assert kept[1000] and not kept[1001] and kept[1002]


def test_filter_keeps_rows_as_they_are(documents):
    rows = [(n, prose(80, n), "en", "s") for n in range(30)] + [(40, "too short"), (41, None)]
    docs = documents(*rows)
    out = quality_rules.keep_good(docs)
    assert out.schema.names == docs.schema.names
    assert sorted(r.doc_id for r in out.collect()) == list(range(30))


@pytest.mark.parametrize("groups", [0, 10**6])
def test_the_join_gives_the_same_either_way(documents, monkeypatch, groups):
    rows = [(n, prose(60 + n % 9, n), ["en", None, "de"][n % 3], f"s{n % 4}") for n in range(60)]
    small = quality_rules.small_enough
    monkeypatch.setattr(quality_rules, "small_enough", lambda table: small(table, groups))
    assert all(r.kept for r in report(documents(*rows)))
