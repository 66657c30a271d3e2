"""Language sets of more than three languages."""

from collections import Counter

import numpy as np

from claimlake.llm.language_mixture import BUCKETS, Model, trigram_bins

PARTS = {
    "de": "der dicke hund und das rad ", "en": "the thin cat with that hat ", "es": "el perro gordo lleva una bicicleta ", "fr": "mais je vous voyais quelquefois ",
    "it": "gli uccelli volano sopra questa collina ",
}


def test_texts_in_all_learned_languages():
    counts = {}
    for name, text in PARTS.items():
        _, bins, _ = trigram_bins([text * 9])
        counts[name] = np.zeros(BUCKETS)
        for spot, n in Counter(bins.tolist()).items():
            counts[name][spot] = n
    main, score, chosen = Model.from_counts(counts).infer(["".join(t * 20 for t in PARTS.values()), "".join(t * 20 for n, t in PARTS.items() if n != "it"), PARTS["fr"] * 3])
    assert chosen == ["de,en,es,fr,it", "de,en,es,fr", "fr"]
    assert 0.1 < score[0] < 0.4 and score[0] < score[1] < 0.5 and main[2] == "fr" and score[2] > 0.99
