"""File sources: SRC-1..7."""
