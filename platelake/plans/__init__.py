"""From input folders to written results."""
