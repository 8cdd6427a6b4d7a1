"""Table readers/writers and the stand-in fixture frames."""
