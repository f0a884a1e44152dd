"""Column builders: booking rules, repeatable draws, pseudonyms."""
