"""Column expressions and vectorised functions over URLs, texts and markup."""
