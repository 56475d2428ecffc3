"""What decontamination finds in single texts."""

import random

from fleetlens.llm import decontam

from .test_text_operators import prose

ITEM = "Tom Smith has 5 apples and gives 3 apples to Anna. How many apples does he have after 2 days?"


def variant(a, b, c, days):
    return f"Later Maria Lee has {a} apples and gives {b} apples to {c}. How many apples does he have after {days} days?"


def find(items, text):
    return {r[0]: r for r in decontam.Index(list(enumerate(items))).find(decontam.Canon(), text)}


def test_variants_of_an_item_in_one_text_do_not_vote_against_each_other():
    two = [variant(12, 7, "Bob", 9), variant(14, 6, "Eve", 8)]
    three = [*two, variant(30, 11, "Carl", 4)]
    for copies in ([ITEM, two[0]], [two[0], ITEM], two, three):
        kind = "verbatim" if ITEM in copies else "reparameterised"
        for between in (" ", " " + prose(5, 40) + " "):
            assert find([ITEM], between.join(copies))[0][4] == kind


def test_variants_with_words_put_in_are_found_beside_each_other():
    broken = [v.replace(" to ", " happily to ") for v in (variant(12, 7, "Bob", 9), variant(14, 6, "Eve", 8))]
    assert find([ITEM], " ".join(broken))[0][4] == "reparameterised"


def test_stray_hits_do_not_vote_against_a_passage():
    item = "take 5 of them and then 6 of those and 7 more of these and again 8 of all"
    stray = " ".join(f"{prose(k, 9)} take {k} of them and" for k in range(10, 40))
    assert find([item], f"{stray} {item} {stray}")[0][4] == "verbatim"
    assert not find([item], stray)


def test_quotes_far_apart_still_count_together():
    item = prose(50, 30)
    words = item.split()
    assert find([item], " ".join([*words[:11], prose(1, 200), *words[12:23]]))[0][1] >= 0.5


def test_items_of_mostly_placeholders_are_found_verbatim_and_only_so():
    items = ["2, 4, 8, 16, 32, 64?", "3 km + 4 km = 7 km", "From Oslo to Bergen 12 km 5 kg 7 h 9 s Anna"]
    for k, item in enumerate(items):
        assert find(items, f"{prose(1, 18)} then {item[0].lower()}{item[1:]} {prose(2, 18)}")[k][4] == "verbatim"
    assert not find(items[:1], "1, 5, 9, 13, 17, 21, 2, 4, 9, 16, 33, 65")


def test_placeholders_in_the_middle_do_not_break_a_run():
    words = prose(70, 60).lower().replace(".", "").split()
    item = " ".join([*words[:28], "5 km and 3 kg 7 ml", *words[34:]])
    quote = item.split()[20:42]
    assert find([item], f"{prose(1, 30)} {' '.join(quote)} {prose(2, 30)}")[0][4] == "verbatim"
    other = " ".join(quote).replace("5 km", "6 km").replace("3 kg", "8 kg")
    assert find([item], f"{prose(1, 30)} {other} {prose(2, 30)}")[0][4] == "reparameterised"


def test_short_items_are_not_found_with_other_values():
    items = ["Who is John Smith?", "What is the capital of France?", "What Color Is The Sky?"]
    for text in ("They asked who is Mary and left.", "It is the capital of Germany now.", "See what Anna did.", "Now who is John Miller, Anna said."):
        assert not find(items, text)
    for k, text in enumerate(("Then who is John Smith? Nobody knew.", "Tell me what is the capital of France, please.", "So what Color Is The Sky? Blue.")):
        assert find(items, text)[k][4] == "verbatim"
    assert find(items, "Now who is John Smith, Anna said.")[0][4] == "verbatim"
