"""Training-data operators: secrets, language, HTML, near duplicates, BPE,
source mixing, toxicity, exact top-k, fingerprints and a keyed token store.

Nothing outside this folder imports it; ``queries`` lists the registered
``opN_<name>`` queries.
"""
