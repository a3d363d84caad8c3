"""Shared by the tests of the corpus operators."""

# Names the operators use for columns of their own.
CLASHES = dict.fromkeys(
    "k1 k2 doc size start taken place quota bucket covered line window anchor at windows fp root a b slot variant fingerprint "
    "candidates items score predicted good maybe sketch_word n_words n_removed kept starts key total block shard mix".split(), 1)
