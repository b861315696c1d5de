"""DataFrame operators. Each is a plain function; most serve batch and stream alike."""
