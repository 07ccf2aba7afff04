"""The lexicon is whole, and its automata match as one would."""

import random

from meshwork.llm import toxicity


def test_every_term_that_passes_is_kept():
    words = ["".join(random.Random(k).choices("abcdefghijklmnop", k=9)) for k in range(300)]
    toxic = {w[:n]: 40 for w in words for n in range(toxicity.SHORTEST, 10)} | {w + " ": 40 for w in words}
    chosen = toxicity.choose_terms(toxic, {}, 1000, 1000)
    assert {t for t, _ in chosen} >= set(words)


def test_many_automata_match_as_one(monkeypatch):
    draw = random.Random(3)
    word = lambda: "".join(draw.choices("abcde", k=draw.randint(4, 11)))
    terms = list({word(): draw.random() < 0.4 for _ in range(25)}.items())
    near = []
    for t, _ in terms * 12:
        for _ in range(draw.randint(0, 3)):
            at = draw.randrange(len(t))
            t = draw.choice((t[:at] + t[at + 1 :], t[:at] + draw.choice("abcdex") + t[at + 1 :], t[:at] + draw.choice("abcdex") + t[at:], t + "e"))
        near.append(t)
    text = " ".join([*near, *(word() for _ in range(300))])
    one = toxicity.Automaton(terms)
    monkeypatch.setattr(toxicity, "GROUP", 4)
    some = toxicity.Automaton(terms)
    assert (len(one.parts), len(some.parts)) == (1, -(-len(terms) // 4))
    assert one.scan(text)[0] == some.scan(text)[0] != []


def test_terms_of_other_scripts_match():
    terms = [("негодяйство", False), ("κακοήθης", True), ("idiote", True)]
    text = "негодяйство негодяйсто доброта κακοήθηςα καλός idioten"
    found, starts = toxicity.Automaton(terms).scan(text)
    assert [(text[a:b], k, e) for a, b, k, e in found] == [("негодяйство", 0, 0), ("негодяйсто", 0, 1), ("κακοήθηςα", 1, 0), ("idioten", 2, 0)]
    assert len(starts) == 6
