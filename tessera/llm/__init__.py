"""Training-data operators: personal data, language-model scores, fingerprints, WARC
archives, near duplicates, URL lists, packing, quality, language, byte-level BPE, spelling
variants, exact duplicates and embedding whitening.
Nothing outside this subpackage imports it."""
