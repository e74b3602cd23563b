"""Named queries over the data folder, each with its SQL where SQL can state it."""
