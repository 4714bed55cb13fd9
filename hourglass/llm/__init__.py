"""Training-data operators: tokenise, score, read archives, de-duplicate, filter and mix documents."""
