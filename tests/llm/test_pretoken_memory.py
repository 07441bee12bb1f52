import numpy as np
import public_tokenizers

from millrace.llm import pretokens


def test_words_go_to_the_model_alone(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = pretokens.load(path)
    assert pretokens._byte_model(path) and not pretokens._byte_model(public_tokenizers.path("word_bpe_49k.json"))
    words = [" foo", "é漢字", "\n\n", "<|endoftext|>", "\x00\u0085", "'s", " 12"]
    want = [tokenizer.encode(w, add_special_tokens=False).ids for w in words]

    class Refusing:
        def __getattr__(self, name):
            if name == "encode_batch_fast":
                raise AssertionError("an encoding per word")
            return getattr(tokenizer, name)

    monkeypatch.setattr(pretokens, "load", lambda _: Refusing())
    assert pretokens.encode_words(words, path) == want


def test_ids_survive_forgetting(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(pretokens, "REMEMBERED", 5)
    monkeypatch.setattr(pretokens, "_remembered", {})
    for texts in (["a b c", None, "b d"], ["c e f g h i j k"], [], ["", "a b it's <|endoftext|>x"], ["a b"]):
        ids, bounds = pretokens.encode_texts(texts, path, "gpt")
        want = [pretokens.load(path).encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want
        assert np.issubdtype(ids.dtype, np.integer)
