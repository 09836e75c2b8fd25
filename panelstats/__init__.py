"""Quality-gated panel analytics over re-published statistical tables, as plain DataFrame functions."""
