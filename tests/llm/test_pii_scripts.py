"""Entities without ASCII digits, in other scripts, and secrets of letters alone."""

import pytest

from tempora.llm import pii

SECRETS = ["sk-" + "abcdefghij" * 2, "ghp_" + "AbCdEfGhIj" * 3, "AKIA" + "ABCDEFGHIJKLMNOP"]
DIGITS = {"arabic": "٠١٢٣٤٥٦٧٨٩", "devanagari": "०१२३४५६७८९", "wide": "０１２３４５６７８９"}
NUMBERS = ["212-555-0100", "+1 212 555 0100", "123-45-6789", "4111 1111 1111 1111", "10.20.30.40"]


def test_every_secret_is_replaced_without_digit_or_title(spark):
    rows = [(k, f"token {s} end") for k, s in enumerate(SECRETS)] + [(8, "plain"), (9, None)]
    out = {r.doc_id: r for r in pii.anonymise(spark.createDataFrame(rows, "doc_id long, text string"), b"k", report=True).collect()}
    assert all(out[k].pii_types == ["secret"] and s not in out[k].text and len(out[k].text) == len(s) + 10 for k, s in enumerate(SECRETS))
    assert out[8].text == "plain" and out[9].text is None


@pytest.mark.parametrize("script", DIGITS)
def test_numbers_stay_in_their_script(script):
    for number in NUMBERS:
        value = number.translate(str.maketrans("0123456789", DIGITS[script]))
        out, made = pii.replace(f"see {value} now", b"k", b"n", 2)
        assert len(made) == 1 and value not in out
        assert all(c in DIGITS[script] for c in out[4:-4] if c.isdigit()) and any(c.isdigit() for c in out)


def test_emails_of_all_letters():
    for value in ("иван.п@почта.рф", "éric@mail.example.com", "ann@müller.de", "Ωmega@x.gr"):
        out, made = pii.replace(f"an {value}, ok", b"k", b"n", 2)
        local = value.split("@")[0]
        assert [(k, v) for k, v, _ in made] == [("email", value)] and local not in out
        assert out.startswith("an ") and out.endswith(", ok") and pii.ENTITY.fullmatch(made[0][2])


def test_mixed_digits_never_share_a_surrogate():
    mixed = ["1٢.3.4.5", "12.3.4.5", "١٢.٣.٤.٥", "१२.3.4.5"]
    new = [pii.surrogate(b"k", "ip", v) for v in mixed]
    assert len(set(new)) == 4 and not set(new) & set(mixed)
