"""Rules (R1-R12), rule catalogues, the missing-file pipeline and the registered queries."""
