"""Training-data operators: language ID, PII, licenses, BPE, decontamination,
near-duplicates, language-model scoring, toxicity, fingerprints and secrets.

Nothing else in the library imports this package.
"""
