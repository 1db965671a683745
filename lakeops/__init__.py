"""Keep layered analytical tables up to date with plain DataFrame operators."""
