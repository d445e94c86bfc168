import public_tokenizers
from hypothesis import given, settings, strategies as st

from cohortica.llm import wordpiece


def _greedy(pieces, word, longest):
    count, at = 0, 0
    while at < len(word):
        for size in range(min(longest, len(word) - at), 0, -1):
            if word[at:at + size] in pieces:
                break
        else:
            return 1
        count, at = count + 1, at + size
    return count


@settings(max_examples=500, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=12),
       st.lists(st.binary(max_size=14).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=8))
def test_automaton_equals_greedy(pieces, words):
    automaton = wordpiece.Automaton(pieces)
    assert [automaton.count(w) for w in words] == [_greedy(pieces, w, 5) for w in words]


def test_marked_pieces_only_end_words():
    pieces = [*[(b,) for b in b"abc"], *[wordpiece.symbols(bytes([b])) for b in b"abc"],
              tuple(b"ab"), tuple(b"bca"), wordpiece.symbols(b"abc"), wordpiece.symbols(b"ca")]
    automaton = wordpiece.Automaton(pieces)
    tokens = lambda word: automaton.count(wordpiece.symbols(word))
    assert tokens(b"abc") == 1 and tokens(b"abca") == 2 and tokens(b"ab") == 2  # "ab" ends no word
    assert tokens(b"abcabc") == 3 and tokens(b"bca") == 2 and tokens(b"bcab") == 2 and tokens(b"a") == 1
    assert tokens(b"") == 0 and tokens(b"xa") == 1


def test_equals_brute_force(odd, small, none):
    pieces = set(wordpiece.load_vocabulary(public_tokenizers.path(wordpiece.VOCABULARY)))
    assert {(b,) for b in range(2 * wordpiece.LAST)} <= pieces
    longest, seen = max(map(len, pieces)), {}
    for docs in (odd, small):
        want = []
        for r in docs.collect():
            counts = []
            for w in (r.text or "").encode().lower().split():
                if w not in seen:
                    seen[w] = _greedy(pieces, wordpiece.symbols(w), longest)
                counts.append(seen[w])
            want.append((r.doc_id, len(counts), sum(counts), max(counts, default=0)))
        got = [tuple(r) for r in wordpiece.token_counts(docs, cache=100).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert wordpiece.token_counts(none).count() == 0
