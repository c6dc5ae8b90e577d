"""Stand-in star schema, SQL texts and the contract query registry."""
