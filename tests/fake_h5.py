"""Stand-in for HDF5 files: a pickled {step: (attrs, {dataset: array})}, same access pattern."""

import pickle


class Group:
    def __init__(self, attrs, data):
        self.attrs, self._data = attrs, data

    def keys(self):
        return self._data.keys()

    def __getitem__(self, key):
        return self._data[key]


class File:
    def __init__(self, steps):
        self._steps = {k: Group(*v) for k, v in steps.items()}

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        return False

    def keys(self):
        return self._steps.keys()

    def __getitem__(self, key):
        return self._steps[key]


def open_file(path):
    with open(path, "rb") as handle:
        return File(pickle.load(handle))


def write_file(path, steps):
    with open(path, "wb") as handle:
        pickle.dump(steps, handle)


class LoggedGroup(Group):
    """Notes every dataset that is taken from it in <file>.log."""

    def __init__(self, group, log, key):
        super().__init__(group.attrs, group._data)
        self._log, self._key = log, key

    def __getitem__(self, key):
        with open(self._log, "a") as log:
            print(self._key, key, sep="\t", file=log)
        return super().__getitem__(key)


def open_logged(path):
    file = open_file(path)
    file._steps = {k: LoggedGroup(g, path + ".log", k) for k, g in file._steps.items()}
    return file
