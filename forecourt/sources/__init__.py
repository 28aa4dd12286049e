"""Where the listing history, dealers, decode and distance tables come from."""
