"""Marketplace events derived row by row from the orders table.

One order is one transaction. Its status and priority pick the kind of sale, so
every order takes part and every branch of the plans is taken by a share of
them.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators.groups import keep
from ledgerloom.plans.nft import element as E, joepegs as J, salvor as S, seaport as Z
from ledgerloom.plans.nft.common import WRAPPED_NATIVE, NATIVE_PLACEHOLDER
from .chain import hx, orders

STRANGER = "0x" + "f" * 40
TOKEN = "0x" + "0" * 38 + "77"


# Columns every kind of sale is built from; functions, as a column needs a session.

def n_sales():
    return F.col("o_custkey") % 3 + 1


def status():
    return F.col("o_orderstatus")


def prio():
    return F.col("o_orderpriority")


def nobody():
    return F.lit("0x" + "0" * 40)


def seller():
    return addr(F.col("o_custkey") + 1)


def buyer():
    return addr(F.col("o_custkey") + 2)


def nft_address():
    return addr(F.col("o_custkey") + 1000)


def ident():
    return F.col("o_orderkey").cast("string")


def cents():
    return F.col("cents")


def base(spark, sf, days: int) -> DataFrame:
    return orders(spark, sf).withColumn("block_timestamp", F.expr(f"o_orderdate + make_dt_interval({days})")) \
        .withColumn("modified_timestamp", F.col("block_timestamp"))


def addr(c) -> Column:
    return hx(c, 40)


def word(c) -> Column:
    return F.lpad(F.lower(F.hex((F.col(c) if isinstance(c, str) else c).cast("bigint"))), 64, "0")


def js(**fields) -> Column:
    return F.to_json(F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()]))


def event(when, index, name, contract, decoded=None, full=None, topics=None, data=None) -> Column:
    """One event, or null (and not computed) where ``when`` does not hold."""
    lit = lambda v, t="string": (v if isinstance(v, Column) else F.lit(v)).cast(t)
    return F.when(when, F.struct(
        lit(index, "bigint").alias("event_index"), lit(name).alias("event_name"), lit(contract).alias("contract_address"),
        lit(decoded).alias("decoded_log"), lit(full).alias("full_decoded_log"),
        (topics if topics is not None else F.lit(None)).cast("array<string>").alias("topics"), lit(data).alias("data")))


def events(df: DataFrame, *groups: Column) -> DataFrame:
    """Rows of all events of each order."""
    own = ["block_number", "block_timestamp", "tx_hash", "modified_timestamp"]
    ev = df.select(*own, addr("o_custkey").alias("origin_from_address"), F.lit("0x01").alias("origin_to_address"),
                   F.lit("0xa9059cbb").alias("origin_function_signature"), F.lit(True).alias("tx_succeeded"),
                   F.inline(F.filter(F.concat(*groups), lambda e: e.isNotNull())))
    # the plans read these rows from a table, several times; so does this
    return keep(ev)


def repeat(n, make) -> Column:
    """Events for i = 0 .. n-1."""
    return F.transform(F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1), make)


def transactions(df: DataFrame) -> DataFrame:
    return df.select("tx_hash", "block_number", "block_timestamp", "modified_timestamp",
                     addr("o_custkey").alias("from_address"),
                     F.when(F.col("o_custkey") % 10 == 9, "0x02").otherwise("0x01").alias("to_address"),
                     F.lit("0xa9059cbb").alias("origin_function_signature"),
                     (F.col("o_custkey") / 1000).alias("tx_fee"),
                     F.concat(F.lit("0x"), F.lpad(F.hex(F.col("o_custkey") % 10), 8, "0")).alias("input_data"))


# -- fees before sales -------------------------------------------------------



def joepegs(spark, sf):
    """Sale k of a transaction is event 10k+5. Royalties come before it (status
    F) or after it (P). Fee transfers come before it, or after it (O), where
    they belong to the next sale; 1-URGENT fees are paid by the buyer, 2-HIGH
    ones by a stranger, 5-LOW has none."""
    df = base(spark, sf, 10_000)
    asset = lambda k: dict(collection=addr(F.col("o_custkey") + k), tokenId=k.cast("string"))
    sale = repeat(n_sales(), lambda k: event(
        F.lit(True), k * 10 + 5, F.when(k % 2 == 0, "TakerBid").otherwise("TakerAsk"), J.EXCHANGE,
        js(amount=F.lit("3"), **asset(k), currency=F.lit(WRAPPED_NATIVE), maker=addr(F.col("o_custkey") + 1),
           taker=addr(F.col("o_custkey") + 2), price=F.col("cents").cast("string"), strategy=F.lit("0x5"),
           orderHash=F.col("tx_hash"), orderNonce=F.lit("1"))))
    royalty = repeat(n_sales(), lambda k: event(
        status().isin("F", "P"), k * 10 + F.when(status() == "F", 0).otherwise(6), "RoyaltyPayment", J.EXCHANGE,
        js(amount=(F.col("o_custkey") + k).cast("string"), **asset(k), currency=F.lit(WRAPPED_NATIVE), royaltyRecipient=F.lit("0x9"))))
    payer = F.when(prio() == "1-URGENT", addr(F.col("o_custkey") + 2)).when(prio() == "2-HIGH", F.lit(STRANGER)).otherwise(F.lit(J.EXCHANGE))
    fee = repeat(n_sales(), lambda k: event(
        prio() != "5-LOW", k * 10 + F.when(status() == "O", 7).otherwise(1), "Transfer", WRAPPED_NATIVE,
        js(src=payer, dst=F.lit(J.FEE_WALLETS[0]), wad=(k + 100).cast("string"))))
    transfers = df.withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), n_sales() - 1))).withColumn(
        "late", F.explode(F.array(F.lit(0), F.lit(1))))
    no = F.col("o_custkey") + F.col("k")
    transfers = transfers.select(
        addr(no).alias("contract_address"), F.expr("block_timestamp + make_dt_interval(late * 5000)").alias("block_timestamp"),
        F.when((no + F.col("late")) % 2 == 0, "erc721_Transfer").otherwise("erc1155_TransferSingle").alias("token_transfer_type"),
        "modified_timestamp")
    return events(df, sale, royalty, fee), transfers, transactions(df)


# -- raw words ---------------------------------------------------------------

def salvor(spark, sf):
    """F: payout with commission and two royalties. O: English auction. P:
    payout of 0 with two shares. 1-URGENT is sent by the owner, 2-HIGH has no
    transfer, 3-MEDIUM two."""
    df = base(spark, sf, 11_000)
    topic = {v: k for k, v in S.TOPICS.items()}
    owner = F.col("o_custkey") + 1
    pad = lambda c: F.concat(F.lit("0x"), word(c))
    tops = lambda name, third: F.array(F.lit(topic[name]), pad("o_custkey"), pad("o_orderkey"), pad(third))
    data = lambda *w: F.concat(F.lit("0x"), *[word(x) for x in w])
    one = lambda *a, **k: F.array(event(*a, **k))
    logs = events(
        df,
        one(F.lit(True), 9, None, S.MARKET, topics=tops("PayoutCompleted", owner),
            data=data(F.when(status() == "P", F.lit(0)).otherwise(F.col("cents")))),
        one(status() == "F", 1, None, S.MARKET, topics=tops("CommissionSent", F.lit(0)), data=data(owner, F.lit(7), F.col("cents"))),
        one(status() == "F", 2, None, S.MARKET, topics=tops("RoyaltyReceived", F.lit(3)), data=data(owner, F.lit(5))),
        one(status() == "F", 3, None, S.MARKET, topics=tops("RoyaltyReceived", F.lit(4)), data=data(owner, F.lit(6))),
        one(status() == "O", 4, None, S.ENGLISH, topics=tops("AuctionSettled", owner), data=data(F.lit(8), F.col("cents") + 1000)),
        one(status() == "P", 5, None, S.MARKET, topics=tops("ShareIncome", F.lit(3)), data=data(owner, F.col("cents"))),
        one(status() == "P", 6, None, S.MARKET, topics=tops("ShareIncome", F.lit(4)), data=data(owner, F.lit(11))))
    logs = logs.withColumn("origin_from_address", F.col("origin_from_address"))
    sender = df.select("tx_hash", F.when(prio() == "1-URGENT", addr(owner)).otherwise(F.lit("0x02")).alias("origin_from_address"))
    logs = logs.drop("origin_from_address").join(sender, "tx_hash")
    copies = F.when(prio() == "2-HIGH", F.array().cast("array<int>")).when(prio() == "3-MEDIUM", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    transfers = df.withColumn("i", F.explode(copies)).select(
        "tx_hash", "block_timestamp", addr("o_custkey").alias("contract_address"), addr(owner).alias("from_address"),
        addr(F.col("o_custkey") + 5 + F.col("i")).alias("to_address"), F.col("o_orderkey").cast("string").alias("token_id"))
    return logs, transfers, transactions(df)


# -- payments before a switch, fee lists after -------------------------------

def element(spark, sf):
    """Sale k of a transaction is event 10k+9, paid natively for status F."""
    df = base(spark, sf, 9_000)
    native = status() == "F"
    currency = F.when(native, F.lit(NATIVE_PLACEHOLDER)).otherwise(F.lit(TOKEN))
    fees = F.when(status() == "P", F.lit("[]")).otherwise(
        F.lit(f'[{{"amount":"3","recipient":"{E.FEE_WALLET}"}},{{"amount":"4","recipient":"{STRANGER}"}},{{"amount":"5","recipient":"{STRANGER}"}}]'))

    def sale(k):
        kind = F.when(k == 0, "ERC721SellOrderFilled").when(k == 1, "ERC721BuyOrderFilled").otherwise("ERC1155SellOrderFilled")
        own = js(erc20Token=currency, maker=addr(F.col("o_custkey") + 1), taker=addr(F.col("o_custkey") + 2), orderHash=F.col("tx_hash"),
                 erc20TokenAmount=F.when(k < 2, F.col("cents").cast("string")), erc20FillAmount=F.when(k == 2, F.col("cents").cast("string")),
                 erc721Token=F.when(k < 2, addr("o_custkey")), erc721TokenId=F.when(k < 2, k.cast("string")),
                 erc1155Token=F.when(k == 2, addr("o_custkey")), erc1155TokenId=F.when(k == 2, k.cast("string")),
                 erc1155FillAmount=F.when(k == 2, F.lit("6")))
        return event(F.lit(True), k * 10 + 9, kind, E.MARKET, F.concat(F.regexp_replace(own, r"\}$", ""), F.lit(',"fees":'), fees, F.lit("}")))

    decoded = events(df, repeat(n_sales(), sale))
    token = df.filter(~native).select(
        "tx_hash", "block_timestamp", "modified_timestamp", F.lit(TOKEN).alias("contract_address"), F.inline(F.array(
            F.struct(F.lit(1).alias("event_index"), F.lit("0x03").alias("to_address"), (F.col("cents") + 50).cast("decimal(38,0)").alias("raw_amount")),
            F.struct(F.lit(2).alias("event_index"), F.lit(E.FEE_WALLET).alias("to_address"), F.lit(20).cast("decimal(38,0)").alias("raw_amount")),
            F.struct(F.lit(3).alias("event_index"), F.lit("0x04").alias("to_address"), F.lit(10).cast("decimal(38,0)").alias("raw_amount")))))
    call = lambda i, frm, to, v: F.struct(i.alias("trace_index"), F.lit(frm).alias("from_address"), F.lit(to).alias("to_address"), v.cast("double").alias("value"))
    calls = F.flatten(F.transform(F.sequence(F.lit(0).cast("bigint"), n_sales() - 1), lambda k: F.array(
        call(k * 4 + 1, "0x05", E.MARKET, k + 10), call(k * 4 + 2, E.MARKET, "0x06", k + 7),
        call(k * 4 + 3, E.MARKET, E.FEE_WALLET, F.lit(2)), call(k * 4 + 4, E.MARKET, "0x07", F.lit(1)))))
    traces = df.filter(native).select("tx_hash", "block_timestamp", "modified_timestamp", F.lit("CALL").alias("type"),
                                      F.lit(True).alias("tx_succeeded"), F.lit(True).alias("trace_succeeded"), F.inline(calls))
    return decoded, token, traces, transactions(df)


# -- order book --------------------------------------------------------------

def item(kind, token, ident, amount, to=None) -> Column:
    lit = lambda v: (v if isinstance(v, Column) else F.lit(v)).cast("string")
    return F.struct(lit(kind).alias("itemType"), lit(token).alias("token"), lit(ident).alias("identifier"),
                    lit(amount).alias("amount"), lit(to).alias("recipient"))


def _positional(items: Column, with_to: bool) -> Column:
    cols = ["itemType", "token", "identifier", "amount"] + (["recipient"] if with_to else [])
    return F.transform(items, lambda x: F.array(*[x[c] for c in cols]))


def order(when, index, contract, order_hash, offerer, recipient, offer: list, asks: list) -> Column:
    """A filled order, in both its named and its positional form."""
    empty = F.filter(F.array(item(0, "", "", "")), lambda x: F.lit(False))
    offers = F.array(*offer) if offer else empty
    considered = F.array(*asks) if asks else empty
    named = F.to_json(F.struct(order_hash.alias("orderHash"), offerer.alias("offerer"), F.lit("0xz").alias("zone"),
                               recipient.alias("recipient"), offers.alias("offer"), considered.alias("consideration")))
    part = lambda name, v: F.concat(F.lit(f'{{"name":"{name}","value":'), v, F.lit("}"))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    full = F.concat(F.lit(f'{{"address":"{contract.upper().replace("0X", "0x")}","name":"OrderFulfilled","data":['),
                    F.concat_ws(",", part("orderHash", quoted(order_hash)), part("offerer", quoted(offerer)),
                                part("zone", F.lit('"0xz"')), part("recipient", quoted(recipient)),
                                part("offer", F.to_json(_positional(offers, False))),
                                part("consideration", F.to_json(_positional(considered, True)))), F.lit("]}"))
    return event(when, index, "OrderFulfilled", contract, named, full, F.array(F.lit(Z.FULFILLED)), order_hash)


FEE = Z.FEE_WALLETS[0]


def single_orders(contract: str) -> Column:
    """Kinds of single orders.

    1-URGENT public buy; 2-HIGH batch of two; 3-MEDIUM private sale;
    4-NOT SPECIFIED offer accepted with fees (status P: privately, with a
    listing in the same transaction); 5-LOW offer without fees (F), scam (O),
    listing that asks for nothing (P).
    """
    h = lambda n: hx(F.col("o_orderkey") * 8 + n, 64)
    pay = lambda amount, to, kind=0: item(kind, nobody() if kind == 0 else F.lit(TOKEN), "0", amount, to)
    nft = item(2, nft_address(), ident(), "1")
    fees = lambda kind=0: [pay("10", F.lit(FEE), kind), pay("20", F.lit(STRANGER), kind)]
    low = prio() == "5-LOW"
    offered = prio() == "4-NOT SPECIFIED"
    return F.array(
        order(prio() == "1-URGENT", 1, contract, h(1), seller(), buyer(), [nft], [pay(cents(), seller()), *fees()]),
        order(prio() == "2-HIGH", 1, contract, h(2), seller(), buyer(), [nft, item(3, nft_address(), F.concat(ident(), F.lit("077")), "5")], [pay(cents(), seller()), *fees()]),
        order(prio() == "3-MEDIUM", 1, contract, h(3), seller(), nobody(), [nft], [pay(cents(), seller()), item(2, nft_address(), ident(), "1", buyer())]),
        order(offered, 1, contract, h(4), buyer(), F.when(status() == "P", nobody()).otherwise(seller()), [pay(cents(), F.lit(None), 1)],
              [item(2, nft_address(), ident(), "1", buyer()), *fees(1)]),
        order(offered & (status() == "P"), 2, contract, h(5), seller(), buyer(), [nft], [pay("1", seller())]),
        order(low & status().isin("F", "O"), 1, contract, h(6), buyer(), F.when(status() == "O", nobody()).otherwise(seller()),
              [pay(cents(), F.lit(None), 1)], [item(2, nft_address(), ident(), "1", buyer())]),
        order(low & (status() == "P"), 1, contract, h(7), seller(), buyer(), [nft], []))


def matched_orders(contract: str, deals: bool = True) -> Column:
    """Matched orders from event 10 on: a listing and a bid (F), an asset for
    an asset with money on top (O), two listings with bids under two match
    events (P)."""
    h = lambda n: hx(F.col("o_orderkey") * 16 + F.lit(2 ** 44) + n, 64)
    pay = lambda amount, to, kind=1: item(kind, F.lit(TOKEN), "0", amount, to)

    def pair(when, at, n, ident):
        listing = order(when, at, contract, h(n), seller(), buyer(), [item(2, nft_address(), ident, "1")],
                        [pay(cents() + n, seller()), pay("10", F.lit(FEE)), pay("20", F.lit(STRANGER))])
        bid = order(when, at + 1, contract, h(n + 1), buyer(), seller(), [pay(cents() + 30, F.lit(None))],
                    [item(2, nft_address(), ident, "1", buyer())])
        data = F.concat(F.lit("0x"), word(F.lit(32)), word(F.lit(2)), F.substring(h(n), 3, 64), F.substring(h(n + 1), 3, 64))
        match = event(when, at + 2, "OrdersMatched", contract, "{}", None, F.array(F.lit(Z.MATCHED)), data)
        return [listing, bid, match]

    f, o, p = status() == "F", status() == "O", status() == "P"
    swap = [order(o, 10, contract, h(0), seller(), buyer(), [item(2, nft_address(), ident(), "1")],
                  [item(2, nft_address(), F.concat(ident(), F.lit("9")), "1", seller()), pay(cents(), buyer())]),
            order(o, 11, contract, h(1), buyer(), seller(), [item(2, nft_address(), F.concat(ident(), F.lit("9")), "1")],
                  [item(2, nft_address(), ident(), "1", buyer())]),
            event(o, 12, "OrdersMatched", contract, "{}", None, F.array(F.lit(Z.MATCHED)),
                  F.concat(F.lit("0x"), word(F.lit(32)), word(F.lit(2)), F.substring(h(0), 3, 64), F.substring(h(1), 3, 64)))]
    return F.array(*pair(f | p, 10, 0, ident()), *pair(p, 13, 4, F.concat(ident(), F.lit("5"))), *(swap if deals else []))


def seaport(spark, sf, version: str, days: int):
    """Decoded events, raw logs and transactions of one contract version."""
    contract = Z.VERSIONS[version].contract
    df = base(spark, sf, days)
    parts = [single_orders(contract)]
    if Z.VERSIONS[version].matching:
        parts.append(matched_orders(contract, Z.VERSIONS[version].matching == "group"))
    ev = events(df, *parts)
    # transfers through an operator rename the asset of public 1-URGENT buys of status O
    moved = events(df, F.array(event((prio() == "1-URGENT") & (status() == "O"), 50, None, addr("o_custkey"), topics=F.array(
        F.lit(Z.TRANSFERS_1155[0]), F.concat(F.lit("0x"), word(F.col("o_custkey") + 1000)), F.concat(F.lit("0x"), word(F.lit(1))),
        F.concat(F.lit("0x"), word(F.col("o_custkey") + 2))), data=F.concat(F.lit("0x"), word("o_orderkey"), word(F.lit(1))))))
    return ev, ev.unionByName(moved), transactions(df)
