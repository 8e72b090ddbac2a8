"""Package part."""
