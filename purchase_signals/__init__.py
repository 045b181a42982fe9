"""Review sentiment and purchase prediction as plain DataFrame functions."""
