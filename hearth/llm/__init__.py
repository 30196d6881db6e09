"""Training-data operators: near-duplicates, mixing, scoring, cleaning, tokenizing.

One module per operator; ``queries`` holds the registered queries. Nothing
outside this package imports it.
"""
