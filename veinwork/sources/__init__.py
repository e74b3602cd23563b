"""Reading raw tables, typing them, and writing results."""
