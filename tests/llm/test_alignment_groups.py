"""The digest's text of a unit, assembled for all tokens at once."""

import numpy as np
import public_tokenizers

from ebbflow.llm import alignment


def test_groups_of_units_are_shown_token_by_token(monkeypatch):
    a = alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    units = [w.encode() for w in (" the", " ofthehand,", " Straßenbahn", " 日本語🙂", " ciónquequedo!!", " x\ny", "  two blanks")]
    want = []
    for u in units:
        ia, ea, ib, eb = (x.tolist() for x in a.spans(u.decode()))
        groups, ga, gb = [], [], []
        both = sorted(set(ea) & set(eb))
        for end in both:
            ga = [str(i) for i, e in zip(ia, ea, strict=True) if (groups and groups[-1][1] or 0) < e <= end]
            gb = [str(i) for i, e in zip(ib, eb, strict=True) if (groups and groups[-1][1] or 0) < e <= end]
            groups.append((",".join(ga) + "|" + ",".join(gb), end))
        want.append(";".join(g for g, _ in groups).encode())
    assert any(b"," in w for w in want) and any(b";" in w for w in want)
    encode = type(a.b).encode

    def plain(self, text, **how):
        assert how.get("return_type") != "proto", "a message object for each token"
        return encode(self, text, **how)

    monkeypatch.setattr(type(a.b), "encode", plain)
    got = alignment.Units(units, a)
    assert got.groups == want and got.ok.all()
    assert np.array_equal(got.sums[:, 2], [w.count(b"|") for w in want])
